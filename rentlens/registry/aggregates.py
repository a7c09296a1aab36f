"""Aggregates (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.config import COMMUTE_TIERS, VALUE_ZONES
from rentlens.functions import classify, numeric
from rentlens.operators import filters, profile
from rentlens.operators.dedupe import latest_by_aggregate
from rentlens.operators.percentiles import grouped_percentiles
from rentlens.plans.marts import count_where
from rentlens.quality import assertions
from rentlens.registry import base
from rentlens.registry.base import query
from rentlens.registry.filters import GAPPY, gappy
from rentlens.registry.layers import AFFORDABILITY, over, rounded
from rentlens.registry.models import monthly
from rentlens.sources.driver_tables import table


def gated(spark, folder):
    """Usable deliveries by their neighbourhood as delivered."""
    return filters.quality_gate(base.raw(spark, folder)).dropna(subset=["neighbourhood"])


def by_place(select: str) -> str:
    return over(
        "gated",
        f"""SELECT neighbourhood, {select} FROM gated
            WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood""",
    )


@query("a1_count", by_place("count(*) AS n"))
def a1(spark, folder):
    return gated(spark, folder).groupBy("neighbourhood").agg(F.count("*").alias("n"))


@query(
    "a2_rounded_mean",
    """SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice)) AS mean_price
       FROM lineitem GROUP BY 1, 2""",
)
def a2(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.round(F.avg("l_extendedprice")).alias("mean_price"))
    )


@query(
    "a3_min_max",
    by_place(
        """min(price_ksh) AS low, max(price_ksh) AS high,
           strftime(min(firehose_arrival_at), '%Y-%m-%d') AS first_day,
           strftime(max(firehose_arrival_at), '%Y-%m-%d') AS last_day"""
    ),
)
def a3(spark, folder):
    day = F.col("firehose_arrival_at").cast("date")
    return (
        gated(spark, folder)
        .groupBy("neighbourhood")
        .agg(
            F.min("price_ksh").alias("low"),
            F.max("price_ksh").alias("high"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        )
    )


@query(
    "a4_conditional_count",
    by_place(
        """CAST(sum(CASE WHEN bedrooms = 0 THEN 1 ELSE 0 END) AS BIGINT) AS studios,
           CAST(sum(CASE WHEN bedrooms = 3 THEN 1 ELSE 0 END) AS BIGINT) AS threes"""
    ),
)
def a4(spark, folder):
    return (
        gated(spark, folder)
        .groupBy("neighbourhood")
        .agg(
            count_where(F.col("bedrooms") == 0).alias("studios"),
            count_where(F.col("bedrooms") == 3).alias("threes"),
        )
    )


@query(
    "a5_conditional_mean",
    by_place("round(avg(CASE WHEN bedrooms = 1 THEN price_ksh END)) AS mean_1br"),
)
def a5(spark, folder):
    one_bed = F.when(F.col("bedrooms") == 1, F.col("price_ksh"))
    return (
        gated(spark, folder)
        .groupBy("neighbourhood")
        .agg(F.round(F.avg(one_bed)).alias("mean_1br"))
    )


@query(
    "a6_median",
    by_place("quantile_cont(CAST(price_ksh AS DOUBLE), 0.5) AS median_price"),
)
def a6(spark, folder):
    return grouped_percentiles(
        gated(spark, folder), ["neighbourhood"], F.col("price_ksh"), {"median_price": 0.5}
    )


@query(
    "a7_quartiles",
    """SELECT l_returnflag, quantile_cont(l_quantity, 0.25) AS p25,
       quantile_cont(l_quantity, 0.75) AS p75 FROM lineitem GROUP BY 1""",
)
def a7(spark, folder):
    """Three groups hold all rows here; they are counted by value first."""
    return grouped_percentiles(
        table(spark, folder, "lineitem"),
        ["l_returnflag"],
        F.col("l_quantity"),
        {"p25": 0.25, "p75": 0.75},
    )


@query(
    "a8_conditional_median",
    by_place(
        """quantile_cont(CAST(price_ksh AS DOUBLE), 0.5) AS p50,
           quantile_cont(CAST(CASE WHEN bedrooms = 1 THEN price_ksh END AS DOUBLE), 0.5)
             AS p50_1br"""
    ),
)
def a8(spark, folder):
    return grouped_percentiles(
        gated(spark, folder),
        ["neighbourhood"],
        F.col("price_ksh"),
        {"p50": 0.5},
        subset=F.col("bedrooms") == 1,
        subset_points={"p50_1br": 0.5},
    )


@query(
    "a9_interquartile_range",
    over("aggregated", "SELECT neighbourhood, iqr_rent_ksh FROM aggregated"),
)
def a9(spark, folder):
    return base.stats(spark, folder).select("neighbourhood", "iqr_rent_ksh")


@query(
    "a10_distinct_days",
    by_place("count(DISTINCT CAST(firehose_arrival_at AS DATE)) AS days_observed"),
)
def a10(spark, folder):
    return (
        gated(spark, folder)
        .groupBy("neighbourhood")
        .agg(
            F.count_distinct(F.col("firehose_arrival_at").cast("date")).alias("days_observed")
        )
    )


@query(
    "a11_max_as_any",
    over(
        "enr",
        """SELECT neighbourhood, max(latitude) AS latitude, max(commute_tier) AS commute_tier,
           max(value_zone) AS value_zone FROM enr WHERE neighbourhood IS NOT NULL GROUP BY 1""",
    ),
)
def a11(spark, folder):
    return (
        base.enriched(spark, folder)
        .dropna(subset=["neighbourhood"])
        .groupBy("neighbourhood")
        .agg(
            F.max("latitude").alias("latitude"),
            classify.max_label(F.col("commute_tier"), COMMUTE_TIERS).alias("commute_tier"),
            classify.max_label(F.col("value_zone"), VALUE_ZONES).alias("value_zone"),
        )
    )


@query("a12_affordability", by_place(f"{AFFORDABILITY} AS affordability_index"))
def a12(spark, folder):
    return (
        gated(spark, folder)
        .groupBy("neighbourhood")
        .agg(
            numeric.affordability(F.avg("price_ksh"), F.max("dist_to_archives_km")).alias(
                "affordability_index"
            )
        )
    )


@query(
    "a13_share",
    by_place(
        rounded(
            "CAST(100 AS DOUBLE) * sum(CASE WHEN price_ksh < 15000 THEN 1 ELSE 0 END)"
            " / nullif(count(*), 0)",
            1,
        )
        + " AS cheap_pct"
    ),
)
def a13(spark, folder):
    return (
        gated(spark, folder)
        .groupBy("neighbourhood")
        .agg(
            numeric.share_pct(count_where(F.col("price_ksh") < 15_000), F.count("*")).alias(
                "cheap_pct"
            )
        )
    )


@query(
    "a14_monthly_rollup",
    over("monthly", "SELECT * REPLACE (strftime(month_start, '%Y-%m-%d') AS month_start) FROM monthly"),
)
def a14(spark, folder):
    return monthly(spark, folder)


@query(
    "a15_global_extremes",
    over(
        "aggregated",
        """SELECT min(affordability_index) AS true_min_index, max(avg_rent_ksh) AS true_max_rent,
           max(total_listings) AS true_max_supply FROM aggregated""",
    ),
)
def a15(spark, folder):
    return base.stats(spark, folder).agg(
        F.min("affordability_index").alias("true_min_index"),
        F.max("avg_rent_ksh").alias("true_max_rent"),
        F.max("total_listings").alias("true_max_supply"),
    )


@query(
    "a16_mean_by_group_and_label",
    over(
        "enr",
        """SELECT neighbourhood, bedroom_label, avg(price_ksh) AS avg_rent_ksh
           FROM enr GROUP BY 1, 2""",
    ),
)
def a16(spark, folder):
    return assertions.bedroom_averages(base.enriched(spark, folder))


@query(
    "a17_run_summary",
    over(
        "raw",
        f"""SELECT count(*) AS total_scraped,
             count(*) FILTER (coalesce(location_raw, '') <> '' AND property_id IS NOT NULL)
               AS posted_ok,
             count(*) FILTER (coalesce(location_raw, '') <> '' AND property_id IS NULL) AS failed,
             count(*) FILTER (coalesce(location_raw, '') = '') AS skipped FROM {GAPPY}""",
    ),
)
def a17(spark, folder):
    return profile.run_summary(
        gappy(spark, folder),
        skipped=F.coalesce("location_raw", F.lit("")) == "",
        failed=F.col("property_id").isNull(),
    )


@query(
    "a19_table_profile",
    over(
        "raw",
        """SELECT count(*) AS total_rows, count(DISTINCT neighbourhood) AS distinct_neighbourhoods,
           strftime(min(firehose_arrival_at), '%Y-%m-%d %H:%M:%S') AS earliest_record,
           strftime(max(firehose_arrival_at), '%Y-%m-%d %H:%M:%S') AS latest_record,
           CAST(sum(CASE WHEN price_ksh IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_prices
           FROM raw""",
    ),
)
def a19(spark, folder):
    return profile.table_profile(base.raw(spark, folder))


@query(
    "a20_latest_by_aggregate",
    """SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       o_totalprice FROM orders QUALIFY row_number() OVER
         (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def a20(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return latest_by_aggregate(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
