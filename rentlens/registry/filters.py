"""Projections, filters, predicates (P), sorts and limits (O), set operations (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.config import COMMUTE_TIERS, VALUE_ZONES
from rentlens.functions import numeric, text
from rentlens.functions.convert import record_json
from rentlens.operators import filters, upsert
from rentlens.operators.dedupe import merge_latest
from rentlens.operators.ranking import with_positions
from rentlens.plans.batch_job import reconciled
from rentlens.plans.canonical import first_records
from rentlens.quality import assertions
from rentlens.registry import base, models
from rentlens.registry.base import query
from rentlens.registry.layers import over
from rentlens.schema import CANONICAL_COLUMNS
from rentlens.sources.driver_tables import table


@query(
    "p1_quality_gate",
    over("gated", "SELECT arrival_seq, property_id, location_raw, price_ksh FROM gated"),
)
def p1(spark, folder):
    return filters.quality_gate(base.raw(spark, folder)).select(
        "arrival_seq", "property_id", "location_raw", "price_ksh"
    )


def gappy(spark, folder):
    """Deliveries with some required fields absent or empty."""
    seq = F.col("arrival_seq")
    return base.raw(spark, folder).withColumns(
        {
            "location_raw": F.when(seq % 7 == 0, F.lit("")).otherwise(F.col("location_raw")),
            "price_raw": F.when(seq % 11 == 0, None).otherwise(F.col("price_raw")),
            "property_id": F.when(seq % 13 == 0, None).otherwise(F.col("property_id")),
        }
    )


GAPPY = """(SELECT arrival_seq, property_id AS whole_id,
  CASE WHEN arrival_seq % 7 = 0 THEN '' ELSE location_raw END AS location_raw,
  CASE WHEN arrival_seq % 11 = 0 THEN NULL ELSE price_raw END AS price_raw,
  CASE WHEN arrival_seq % 13 = 0 THEN NULL ELSE property_id END AS property_id FROM raw)"""


@query(
    "p2_required_fields",
    over(
        "raw",
        f"""SELECT arrival_seq, CASE WHEN missing = '' THEN '' ELSE
          'Missing required fields: ' || missing END AS error
        FROM (SELECT arrival_seq, concat_ws(', ',
                CASE WHEN coalesce(location_raw, '') = '' THEN 'location_raw' END,
                CASE WHEN coalesce(price_raw, '') = '' THEN 'price_raw' END,
                CASE WHEN coalesce(property_id, '') = '' THEN 'property_id' END) AS missing
              FROM {GAPPY})""",
    ),
)
def p2(spark, folder):
    accepted, rejected = filters.split_required(gappy(spark, folder))
    return accepted.select("arrival_seq", F.lit("").alias("error")).unionByName(
        rejected.select("arrival_seq", "error")
    )


@query(
    "p3_empty_location_skipped",
    over("raw", f"SELECT arrival_seq, location_raw FROM {GAPPY} WHERE location_raw <> ''"),
)
def p3(spark, folder):
    return filters.not_empty(gappy(spark, folder), "location_raw").select(
        "arrival_seq", "location_raw"
    )


@query(
    "p4_out_of_range_null",
    over(
        "raw",
        """SELECT arrival_seq, CASE WHEN bedrooms BETWEEN 0 AND 20 THEN bedrooms END AS bedrooms,
           CASE WHEN bathrooms BETWEEN 0 AND 10 THEN bathrooms END AS bathrooms FROM raw""",
    ),
)
def p4(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq",
        numeric.within_or_null(F.col("bedrooms"), 0, 20).alias("bedrooms"),
        numeric.within_or_null(F.col("bathrooms"), 0, 10).alias("bathrooms"),
    )


@query(
    "p5_blank_default",
    over(
        "raw",
        """SELECT arrival_seq,
           coalesce(nullif(trim(property_type), ''), 'Unknown') AS property_type,
           coalesce(nullif(trim(title), ''), 'No title') AS title FROM raw""",
    ),
)
def p5(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq",
        text.trimmed_or(F.col("property_type"), "Unknown").alias("property_type"),
        text.trimmed_or(F.col("title"), "No title").alias("title"),
    )


@query(
    "p6_chart_axes",
    over(
        "raw",
        """SELECT arrival_seq, dist_to_archives_km, price_ksh FROM raw
           WHERE dist_to_archives_km IS NOT NULL AND price_ksh IS NOT NULL AND price_ksh > 1000""",
    ),
)
def p6(spark, folder):
    return filters.chartable(base.raw(spark, folder)).select(
        "arrival_seq", "dist_to_archives_km", "price_ksh"
    )


@query(
    "p7_minimum_support",
    over(
        "stg",
        """SELECT neighbourhood, count(*) AS total_listings FROM stg
           WHERE neighbourhood IS NOT NULL GROUP BY 1 HAVING count(*) >= 3""",
    ),
)
def p7(spark, folder):
    counts = (
        base.staged(spark, folder)
        .dropna(subset=["neighbourhood"])
        .groupBy("neighbourhood")
        .agg(F.count("*").alias("total_listings"))
    )
    return filters.supported(counts)


@query(
    "p8_recent_arrivals",
    """SELECT event_id, event_type FROM events
       WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
)
def p8(spark, folder):
    events = table(spark, folder, "events")
    asof = events.select(F.max("ts")).scalar()
    return filters.recent(events, "ts", asof, 2).select("event_id", "event_type")


@query(
    "p9_star_and_derived",
    """SELECT *, l_extendedprice * (1 - l_discount) AS net_price FROM (SELECT l_orderkey,
       l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem)""",
)
def p9(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    return lines.select(
        "*", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price")
    )


@query(
    "p10_column_subset",
    over("raw", f"SELECT {', '.join(CANONICAL_COLUMNS)} FROM raw"),
)
def p10(spark, folder):
    return base.raw(spark, folder).select(CANONICAL_COLUMNS)


@query(
    "p11_type_casts",
    over(
        "raw",
        """SELECT arrival_seq, latitude, longitude, dist_to_archives_km,
           CASE WHEN arrival_seq % 5 = 0 THEN NULL ELSE price_ksh END AS price_ksh,
           bedrooms, bathrooms FROM raw""",
    ),
)
def p11(spark, folder):
    """Numbers arriving as text, some unreadable."""
    rows = base.raw(spark, folder)
    columns = [
        "latitude", "longitude", "dist_to_archives_km", "price_ksh", "bedrooms", "bathrooms",
    ]
    as_text = rows.select("arrival_seq", *[F.col(c).cast("string").alias(c) for c in columns])
    return filters.cast_columns(
        as_text.withColumn(
            "price_ksh",
            F.when(F.col("arrival_seq") % 5 == 0, F.lit("on call")).otherwise(F.col("price_ksh")),
        )
    )


@query(
    "p12_nulls_dropped",
    over(
        "raw",
        """SELECT arrival_seq, '{"property_id":"' || property_id || '"'
            || CASE WHEN neighbourhood IS NULL THEN ''
                    ELSE ',"neighbourhood":"' || neighbourhood || '"' END
            || ',"bedrooms":' || bedrooms || '}' AS record FROM raw""",
    ),
)
def p12(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq", record_json("property_id", "neighbourhood", "bedrooms").alias("record")
    )


@query(
    "p13_first_non_empty",
    over(
        "raw",
        """SELECT arrival_seq, coalesce(nullif(CASE WHEN arrival_seq % 3 = 0 THEN '' ELSE title END, ''),
             nullif(CASE WHEN arrival_seq % 6 = 0 THEN NULL ELSE source_url END, ''),
             'Unnamed Property') AS title FROM raw""",
    ),
)
def p13(spark, folder):
    seq = F.col("arrival_seq")
    return base.raw(spark, folder).select(
        "arrival_seq",
        text.first_non_empty(
            F.when(seq % 3 == 0, F.lit("")).otherwise(F.col("title")),
            F.when(seq % 6 != 0, F.col("source_url")),
            default="Unnamed Property",
        ).alias("title"),
    )


@query(
    "p14_in_not_in_between",
    over(
        "enr",
        f"""SELECT property_id, commute_tier, value_zone, price_ksh FROM enr
            WHERE commute_tier IN ('{COMMUTE_TIERS[1]}', '{COMMUTE_TIERS[2]}')
              AND value_zone NOT IN ('{VALUE_ZONES[0]}') AND price_ksh BETWEEN 15000 AND 60000
              AND NOT (bedrooms = 2 AND price_ksh < 20000)""",
    ),
)
def p14(spark, folder):
    price = F.col("price_ksh")
    return (
        base.enriched(spark, folder)
        .filter(
            F.col("commute_tier").isin(COMMUTE_TIERS[1], COMMUTE_TIERS[2])
            & ~F.col("value_zone").isin(VALUE_ZONES[0])
            & price.between(15_000, 60_000)
            & ~((F.col("bedrooms") == 2) & (price < 20_000))
        )
        .select("property_id", "commute_tier", "value_zone", "price_ksh")
    )


@query(
    "p15_null_keys_excluded",
    over(
        "stg",
        """SELECT property_id, neighbourhood, strftime(scraped_date, '%Y-%m-%d') AS scraped_date
           FROM stg WHERE neighbourhood IS NOT NULL AND scraped_date IS NOT NULL""",
    ),
)
def p15(spark, folder):
    return filters.with_group(base.staged(spark, folder), "neighbourhood", "scraped_date").select(
        "property_id", "neighbourhood", "scraped_date"
    )


# Order is not compared, so each sorted result carries its position.
@query(
    "o1_by_index_nulls_last",
    over(
        "aggregated",
        """SELECT neighbourhood, affordability_index, row_number() OVER
             (ORDER BY affordability_index ASC NULLS LAST, neighbourhood) AS position
           FROM aggregated""",
    ),
)
def o1(spark, folder):
    index = F.col("affordability_index").asc_nulls_last()
    rows = base.stats(spark, folder).select("neighbourhood", "affordability_index")
    return with_positions(rows, "position", index, F.col("neighbourhood").asc())


@query(
    "o2_by_overall_rank",
    over(
        "finder",
        """SELECT neighbourhood, overall_value_rank, row_number() OVER
             (ORDER BY overall_value_rank, neighbourhood) AS position FROM finder""",
    ),
)
def o2(spark, folder):
    rows = base.finder(spark, folder).select("neighbourhood", "overall_value_rank")
    order = F.col("overall_value_rank").asc(), F.col("neighbourhood").asc()
    return with_positions(rows, "position", *order)


@query(
    "o3_by_group_and_month",
    over(
        "trends",
        """SELECT neighbourhood, strftime(month_start, '%Y-%m-%d') AS month_start,
             listing_count, row_number() OVER (ORDER BY neighbourhood, month_start) AS position
           FROM trends""",
    ),
)
def o3(spark, folder):
    rows = models.q8(spark, folder).select("neighbourhood", "month_start", "listing_count")
    order = F.col("neighbourhood").asc(), F.col("month_start").asc()
    return with_positions(rows, "position", *order)


@query(
    "o4_row_at_rank",
    over(
        "finder",
        """SELECT neighbourhood, composite_score FROM finder WHERE overall_value_rank = 1
           ORDER BY neighbourhood LIMIT 1""",
    ),
)
def o4(spark, folder):
    return filters.top_ranked(
        base.finder(spark, folder), "overall_value_rank", 1, "neighbourhood"
    ).select("neighbourhood", "composite_score")


@query("o5_row_cap", over("raw", "SELECT * REPLACE (strftime(firehose_arrival_at, "
       "'%Y-%m-%d %H:%M:%S') AS firehose_arrival_at) FROM raw ORDER BY arrival_seq LIMIT 10000"))
def o5(spark, folder):
    """The cap on records per run, which is the feature here."""
    return first_records(base.raw(spark, folder), "arrival_seq", 10_000)


BROKEN_FINDER = """(SELECT * REPLACE (CASE WHEN total_listings % 2 = 0 THEN 'Project Star'
   ELSE 'Premium Location' END AS verdict) FROM finder)"""


def broken_finder(spark, folder):
    """A ranking whose verdicts do not follow their criteria."""
    return base.finder(spark, folder).withColumn(
        "verdict",
        F.when(F.col("total_listings") % 2 == 0, "Project Star").otherwise("Premium Location"),
    )


@query(
    "u1_violation_union",
    over(
        "finder",
        f"""SELECT neighbourhood, verdict, sweet_spot_pct, dist_to_archives_km,
              'Project Star criteria violated' AS failure_reason FROM {BROKEN_FINDER}
            WHERE verdict = 'Project Star' AND NOT (sweet_spot_pct >= 60 AND dist_to_archives_km <= 8)
            UNION ALL
            SELECT neighbourhood, verdict, sweet_spot_pct, dist_to_archives_km,
              'Premium Location criteria violated' FROM {BROKEN_FINDER}
            WHERE verdict = 'Premium Location'
              AND NOT (dist_to_archives_km <= 5 AND median_rent_ksh >= 50000)""",
    ),
)
def u1(spark, folder):
    return assertions.verdict_contract(broken_finder(spark, folder))


def split_by_arrival(spark, folder):
    """Target and stage: deliveries before and from the middle of the period."""
    columns = ["property_id", "arrival_seq", "price_ksh", "firehose_arrival_at"]
    rows = base.raw(spark, folder).select(columns)
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return rows.filter(F.col("firehose_arrival_at") < cut), rows.filter(
        F.col("firehose_arrival_at") >= cut
    )


STAGE = "(SELECT * FROM raw WHERE firehose_arrival_at >= TIMESTAMP '1999-01-01')"
TARGET = "(SELECT * FROM raw WHERE firehose_arrival_at < TIMESTAMP '1999-01-01')"
SPLIT_COLUMNS = (
    "property_id, arrival_seq, price_ksh, "
    "strftime(firehose_arrival_at, '%Y-%m-%d %H:%M:%S') AS firehose_arrival_at"
)


@query(
    "u2_upsert_union",
    over(
        "raw",
        f"""SELECT {SPLIT_COLUMNS} FROM {TARGET} t
            WHERE NOT EXISTS (SELECT 1 FROM {STAGE} s WHERE s.property_id = t.property_id)
            UNION ALL SELECT {SPLIT_COLUMNS} FROM {STAGE}""",
    ),
)
def u2(spark, folder):
    target, stage = split_by_arrival(spark, folder)
    return upsert.upsert(target, stage, ["property_id"])


@query(
    "u3_reconciled_tables",
    over(
        "raw",
        f"""SELECT {SPLIT_COLUMNS} FROM raw QUALIFY row_number() OVER
            (PARTITION BY property_id ORDER BY firehose_arrival_at DESC, arrival_seq DESC) = 1""",
    ),
)
def u3(spark, folder):
    target, stage = split_by_arrival(spark, folder)
    return merge_latest(target, stage, ["property_id"], ["firehose_arrival_at", "arrival_seq"])


@query(
    "u3_reconciled_by_ingestion",
    over(
        "raw",
        f"""SELECT property_id, ingested_at, origin FROM (
              SELECT *, 'stream' AS origin FROM {TARGET} UNION ALL
              SELECT *, 'batch' FROM {STAGE})
            QUALIFY row_number() OVER (PARTITION BY property_id ORDER BY ingested_at DESC, scraped_at DESC, source_url DESC, location_raw DESC,
            neighbourhood DESC NULLS LAST, latitude DESC, longitude DESC,
            dist_to_archives_km DESC NULLS LAST, price_raw DESC, price_ksh DESC) = 1""",
    ),
)
def u3_ingestion(spark, folder):
    rows = base.raw(spark, folder)
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    streamed = rows.filter(F.col("firehose_arrival_at") < cut)
    batch = rows.filter(F.col("firehose_arrival_at") >= cut)
    return reconciled(streamed, batch).select("property_id", "ingested_at", "origin")
