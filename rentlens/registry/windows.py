"""Windows (W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.operators.dedupe import latest_per_key
from rentlens.operators.filters import quality_gate
from rentlens.operators.ranking import RankBy, with_ranks
from rentlens.plans import marts, staging
from rentlens.quality import assertions
from rentlens.registry import base
from rentlens.registry.base import query
from rentlens.registry.layers import CLEAN, NEWEST, over, pct, rounded
from rentlens.registry.models import monthly
from rentlens.sources.driver_tables import table


@query(
    "w1_latest_arrival",
    over(
        "gated",
        """SELECT property_id, arrival_seq, price_ksh FROM gated QUALIFY row_number() OVER
           (PARTITION BY property_id ORDER BY firehose_arrival_at DESC NULLS LAST,
            arrival_seq DESC) = 1""",
    ),
)
def w1(spark, folder):
    return latest_per_key(
        quality_gate(base.raw(spark, folder)),
        ["property_id"],
        ["firehose_arrival_at", "arrival_seq"],
    ).select("property_id", "arrival_seq", "price_ksh")


@query(
    "w2_latest_ingestion",
    over(
        "gated",
        f"""SELECT * REPLACE (strftime(scraped_date, '%Y-%m-%d') AS scraped_date,
              strftime(scraped_at_eat, '%Y-%m-%d %H:%M:%S') AS scraped_at_eat) FROM (
            SELECT {CLEAN}, ingested_at, '2026-01-01 00:00:00' AS batch_cleaned_at
            FROM (SELECT * FROM gated QUALIFY row_number() OVER (PARTITION BY property_id
                  ORDER BY ingested_at DESC, {NEWEST}) = 1))""",
    ),
)
def w2(spark, folder):
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    return staging.batch_cleaned(base.landed(spark, folder), stamp)


@query(
    "w3_three_ranks",
    over("stats", "SELECT neighbourhood, value_rank, price_rank, supply_rank FROM stats"),
)
def w3(spark, folder):
    return base.stats(spark, folder).select(
        "neighbourhood", "value_rank", "price_rank", "supply_rank"
    )


@query(
    "w3_rank_over_ranges",
    """SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS price_rank,
       rank() OVER (ORDER BY o_custkey) AS customer_rank FROM orders""",
)
def w3_ranges(spark, folder):
    """Ranks over a table too large for one sorted window."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    ranks = [
        RankBy("price_rank", "o_totalprice", descending=True),
        RankBy("customer_rank", "o_custkey"),
    ]
    return with_ranks(orders, ranks).select(
        "o_orderkey", "price_rank", "customer_rank"
    )


@query(
    "w4_component_ranks",
    over(
        "finder",
        """SELECT neighbourhood, price_rank, distance_rank, consistency_rank, supply_rank
           FROM finder""",
    ),
)
def w4(spark, folder):
    return base.finder(spark, folder).select(
        "neighbourhood", "price_rank", "distance_rank", "consistency_rank", "supply_rank"
    )


@query(
    "w5_rank_over_score",
    over("finder", "SELECT neighbourhood, composite_score, overall_value_rank FROM finder"),
)
def w5(spark, folder):
    return base.finder(spark, folder).select(
        "neighbourhood", "composite_score", "overall_value_rank"
    )


MONTH = "strftime(month_start, '%Y-%m-%d') AS month_start"


@query(
    "w6_previous_month",
    over(
        "trends",
        f"SELECT neighbourhood, {MONTH}, prev_month_median, prev_month_count FROM trends",
    ),
)
def w6(spark, folder):
    return marts.with_changes(monthly(spark, folder)).select(
        "neighbourhood", "month_start", "prev_month_median", "prev_month_count"
    )


@query(
    "w7_pivot_lookup",
    over(
        "enr",
        """SELECT *, max(CASE WHEN bedroom_label = '1 BR' THEN avg_rent_ksh END)
             OVER (PARTITION BY neighbourhood) AS local_1br_avg_price
           FROM (SELECT neighbourhood, bedroom_label, avg(price_ksh) AS avg_rent_ksh
                 FROM enr GROUP BY 1, 2)""",
    ),
)
def w7(spark, folder):
    return assertions.with_one_bed_price(
        assertions.bedroom_averages(base.enriched(spark, folder))
    )


@query(
    "w8_rolling_rent",
    over(
        "monthly",
        f"""SELECT neighbourhood, {MONTH},
              {rounded("avg(avg_rent_ksh) OVER w", 2)} AS rolling_avg_rent_ksh,
              median(median_rent_ksh) OVER w AS rolling_median_rent_ksh
            FROM monthly WINDOW w AS (PARTITION BY neighbourhood ORDER BY month_start
                                      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    ),
)
def w8(spark, folder):
    return marts.rolling_rent(monthly(spark, folder)).select(
        "neighbourhood", "month_start", "rolling_avg_rent_ksh", "rolling_median_rent_ksh"
    )


@query(
    "w9_yearly_change",
    over(
        "monthly",
        f"""SELECT m.neighbourhood, strftime(m.month_start, '%Y-%m-%d') AS month_start,
              y.median_rent_ksh AS year_ago_median,
              {pct('m.median_rent_ksh', 'y.median_rent_ksh')} AS yoy_rent_change_pct
            FROM monthly m LEFT JOIN monthly y ON m.neighbourhood = y.neighbourhood
              AND y.month_start = CAST(m.month_start - INTERVAL 12 MONTH AS DATE)""",
    ),
)
def w9(spark, folder):
    return marts.yearly_change(monthly(spark, folder)).select(
        "neighbourhood", "month_start", "year_ago_median", "yoy_rent_change_pct"
    )
