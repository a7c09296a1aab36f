"""Classifiers (C) and scalar functions (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.config import DEFAULTS
from rentlens.functions import classify, convert, dates, geo, numeric, parse, text
from rentlens.operators.filters import quality_gate
from rentlens.plans import marts
from rentlens.registry import base, layers
from rentlens.registry.base import query
from rentlens.registry.layers import over, rounded
from rentlens.registry.models import monthly
from rentlens.sources import records
from rentlens.sources.driver_tables import table

KM, PRICE = "dist_to_archives_km", "price_ksh"


@query(
    "c1_value_zone",
    over("raw", f"SELECT arrival_seq, {layers.VALUE_ZONE} AS value_zone FROM raw"),
)
def c1(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq", classify.value_zone(F.col(PRICE), F.col(KM)).alias("value_zone")
    )


@query(
    "c2_batch_value_zone",
    over("gated", f"SELECT arrival_seq, {layers.VALUE_ZONE} AS value_zone FROM gated"),
)
def c2(spark, folder):
    return quality_gate(base.raw(spark, folder)).select(
        "arrival_seq", classify.batch_value_zone(F.col(PRICE), F.col(KM)).alias("value_zone")
    )


@query(
    "c3_price_bucket",
    f"""SELECT l_orderkey, l_linenumber, {layers.PRICE_BUCKET} AS price_bucket
        FROM (SELECT *, l_extendedprice AS price_ksh FROM lineitem)""",
)
def c3(spark, folder):
    """Over fractional prices too, where the gaps between buckets are 'Unknown'."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        classify.price_bucket(F.col("l_extendedprice")).alias("price_bucket"),
    )


@query(
    "c4_commute_tier",
    over("raw", f"SELECT arrival_seq, {layers.COMMUTE_TIER} AS commute_tier FROM raw b"),
)
def c4(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq", classify.commute_tier(F.col(KM)).alias("commute_tier")
    )


@query(
    "c5_location_segment",
    over("raw", f"SELECT arrival_seq, {layers.LOCATION_SEGMENT} AS location_segment FROM raw b"),
)
def c5(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq", classify.location_segment(F.col(KM)).alias("location_segment")
    )


@query(
    "c6_sweet_spot",
    over("enr", "SELECT property_id, value_zone, bedrooms, is_sweet_spot FROM enr"),
)
def c6(spark, folder):
    return base.enriched(spark, folder).select(
        "property_id", "value_zone", "bedrooms", "is_sweet_spot"
    )


@query(
    "c7_bedroom_label",
    over("stg", f"SELECT property_id, {layers.BEDROOM_LABEL} AS bedroom_label FROM stg b"),
)
def c7(spark, folder):
    return base.staged(spark, folder).select(
        "property_id", classify.bedroom_label(F.col("bedrooms")).alias("bedroom_label")
    )


@query(
    "c8_data_confidence",
    over(
        "trends",
        """SELECT neighbourhood, strftime(month_start, '%Y-%m-%d') AS month_start,
           listing_count, data_confidence_score FROM trends""",
    ),
)
def c8(spark, folder):
    return marts.with_changes(monthly(spark, folder)).select(
        "neighbourhood", "month_start", "listing_count", "data_confidence_score"
    )


@query("c9_verdict", over("finder", "SELECT neighbourhood, sweet_spot_pct, verdict FROM finder"))
def c9(spark, folder):
    return base.finder(spark, folder).select("neighbourhood", "sweet_spot_pct", "verdict")


@query(
    "c10_is_weekend",
    "SELECT o_orderkey, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders",
)
def c10(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", dates.is_weekend(F.col("o_orderdate")).alias("is_weekend")
    )


@query(
    "f1a_trim_and_case",
    over(
        "raw",
        f"""SELECT arrival_seq, trim(location_raw) AS location_raw,
            {layers.proper('neighbourhood')} AS neighbourhood, lower(title) AS title FROM raw""",
    ),
)
def f1a(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq",
        F.trim("location_raw").alias("location_raw"),
        text.proper_case(F.col("neighbourhood")).alias("neighbourhood"),
        F.lower("title").alias("title"),
    )


@query(
    "f1b_blank_and_null",
    over(
        "raw",
        """SELECT arrival_seq, nullif(trim(property_type), '') AS property_type,
           coalesce(neighbourhood, 'Unknown') AS neighbourhood FROM raw""",
    ),
)
def f1b(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq",
        text.blank_to_null(F.trim("property_type")).alias("property_type"),
        F.coalesce("neighbourhood", F.lit("Unknown")).alias("neighbourhood"),
    )


@query(
    "f1c_replace_and_split",
    over(
        "raw",
        """SELECT arrival_seq, replace(price_raw, ',', '') AS price_text,
           split_part(location_raw, ',', 1) AS place,
           split_part(ingested_at, ':', 1) AS before_colon FROM raw""",
    ),
)
def f1c(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq",
        F.replace("price_raw", F.lit(","), F.lit("")).alias("price_text"),
        text.first_part(F.col("location_raw"), ",").alias("place"),
        text.first_part(F.col("ingested_at"), ":").alias("before_colon"),
    )


@query("f2_tooltip", over("points", "SELECT property_id, tooltip_label FROM points"))
def f2(spark, folder):
    return marts.price_points(base.enriched(spark, folder), base.calendar(spark, folder)).select(
        "property_id", "tooltip_label"
    )


SECONDS = "'%Y-%m-%d %H:%M:%S'"


@query(
    "f3a_text_to_timestamp",
    over("raw", f"SELECT arrival_seq, strftime({layers.OBSERVED}, {SECONDS}) AS observed FROM raw"),
)
def f3a(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq", dates.utc_timestamp(F.col("scraped_at")).alias("observed")
    )


@query(
    "f3b_local_time",
    f"SELECT event_id, strftime(ts + INTERVAL 3 HOUR, {SECONDS}) AS local_time FROM events",
)
def f3b(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", dates.to_zone(F.col("ts"), DEFAULTS.local_zone).alias("local_time")
    )


@query(
    "f3c_utc_day",
    over(
        "raw",
        f"SELECT arrival_seq, strftime(CAST({layers.OBSERVED} AS DATE), '%Y-%m-%d') AS day FROM raw",
    ),
)
def f3c(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq", dates.utc_day(F.col("scraped_at")).alias("day")
    )


@query(
    "f3d_date_parts",
    """SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(quarter(ts) AS INT) AS quarter,
       CAST(month(ts) AS INT) AS month, CAST(dayofweek(ts) AS INT) AS dow,
       strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_start FROM events""",
)
def f3d(spark, folder):
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        F.year(ts).alias("year"),
        F.quarter(ts).alias("quarter"),
        F.month(ts).alias("month"),
        (F.dayofweek(ts) - 1).alias("dow"),
        F.trunc(ts, "month").alias("month_start"),
    )


@query(
    "f3e_current_stamp",
    """SELECT o_orderkey, o_orderdate + to_years(CAST(100 * (o_orderkey % 2) AS INT)) < now()
         AS is_past FROM orders""",
)
def f3e(spark, folder):
    """The stamp itself changes with the clock; on which side of it orders lie, every
    other one moved by a century, does not."""
    moved = F.add_months(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 2 * 1200).cast("int"))
    return table(spark, folder, "orders").select(
        "o_orderkey", (moved.cast("timestamp_ntz") < dates.now_utc()).alias("is_past")
    )


@query(
    "f4_timestamp_by_pattern",
    over(
        "raw",
        f"""SELECT arrival_seq, strftime(try_strptime(scraped_at, '%Y-%m-%dT%H:%M:%S+00:00'),
            {SECONDS}) AS observed FROM raw""",
    ),
)
def f4(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq",
        dates.timestamp_by_pattern(
            F.col("scraped_at"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
        ).alias("observed"),
    )


@query("f5_date_spine", over("calendar", "SELECT strftime(date_day, '%Y-%m-%d') AS date_day FROM calendar"))
def f5(spark, folder):
    return base.calendar(spark, folder).select("date_day")


@query(
    "f6_date_labels",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_id,
       strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%B %Y') AS month_year,
       upper(strftime(o_orderdate, '%a')) AS day_short,
       strftime(o_orderdate, '%A') AS day_name FROM orders""",
)
def f6(spark, folder):
    day = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMMM yyyy").alias("month_year"),
        F.upper(F.date_format(day, "EEE")).alias("day_short"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


@query(
    "f7_rounding",
    f"""SELECT l_orderkey, l_linenumber, round(l_extendedprice) AS whole,
        {rounded('l_extendedprice * l_discount', 2)} AS cents,
        abs(l_quantity - 25) AS gap FROM lineitem""",
)
def f7(spark, folder):
    price = F.col("l_extendedprice")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(price).alias("whole"),
        numeric.round_to(price * F.col("l_discount"), 2).alias("cents"),
        F.abs(F.col("l_quantity") - 25).alias("gap"),
    )


@query(
    "f8_pct_vs_median",
    over("enr", "SELECT property_id, price_vs_neighbourhood_median FROM enr"),
)
def f8(spark, folder):
    return base.enriched(spark, folder).select("property_id", "price_vs_neighbourhood_median")


@query(
    "f9_monthly_change",
    over(
        "trends",
        """SELECT neighbourhood, strftime(month_start, '%Y-%m-%d') AS month_start,
           mom_rent_change_ksh, mom_rent_change_pct FROM trends""",
    ),
)
def f9(spark, folder):
    return marts.with_changes(monthly(spark, folder)).select(
        "neighbourhood", "month_start", "mom_rent_change_ksh", "mom_rent_change_pct"
    )


@query(
    "f10_composite_score",
    over("finder", "SELECT neighbourhood, composite_score FROM finder"),
)
def f10(spark, folder):
    return base.finder(spark, folder).select("neighbourhood", "composite_score")


@query(
    "f11_price_parser",
    over("raw", "SELECT arrival_seq, price_raw, price_ksh AS parsed FROM raw"),
)
def f11(spark, folder):
    return base.raw(spark, folder).select(
        "arrival_seq", "price_raw", parse.price(F.col("price_raw")).alias("parsed")
    )


TITLES = """CASE l_linenumber % 4 WHEN 0 THEN 'Airy ' || CAST(l_quantity AS INT) || ' Bedroom flat'
    WHEN 1 THEN CAST(l_quantity AS INT) || 'bd with view' WHEN 2 THEN 'Studio, 1 bed'
    ELSE 'Modern rental' END"""


@query(
    "f12_bedroom_parser",
    f"""SELECT l_orderkey, l_linenumber, {TITLES} AS title,
        CASE l_linenumber % 4 WHEN 0 THEN CAST(l_quantity AS INT)
          WHEN 1 THEN CAST(l_quantity AS INT) WHEN 2 THEN 0 END AS bedrooms FROM lineitem""",
)
def f12(spark, folder):
    count = F.col("l_quantity").cast("int").cast("string")
    arm = F.col("l_linenumber") % 4
    title = (
        F.when(arm == 0, F.concat(F.lit("Airy "), count, F.lit(" Bedroom flat")))
        .when(arm == 1, F.concat(count, F.lit("bd with view")))
        .when(arm == 2, F.lit("Studio, 1 bed"))
        .otherwise(F.lit("Modern rental"))
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", title.alias("title")
    )
    return lines.withColumn("bedrooms", parse.bedrooms(F.col("title"), F.lit(None)))


POINTS = """(SELECT o_orderkey, -1.6e0 + (o_orderkey % 700) / 1000e0 AS lat,
  36.4e0 + (o_custkey % 900) / 1000e0 AS lon FROM orders)"""


@query("f14_geodesic_km", layers.vincenty_sql(POINTS, "o_orderkey", "km"))
def f14(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lat = F.lit(-1.6) + (F.col("o_orderkey") % 700) / F.lit(1000.0)
    lon = F.lit(36.4) + (F.col("o_custkey") % 900) / F.lit(1000.0)
    return orders.select(
        "o_orderkey",
        geo.geodesic_km(lat, lon, DEFAULTS.origin_lat, DEFAULTS.origin_lon).alias("km"),
    )


ANTIPODES = """(SELECT c_custkey, 1.285e0 + (c_custkey % 211 - 105) / 100e0 AS lat,
  -143.1742e0 + (c_custkey % 97 - 48) / 50e0 AS lon FROM customer)"""


@query("f14_geodesic_opposite", layers.opposite_sql(ANTIPODES, "c_custkey", "km"))
def f14_opposite(spark, folder):
    """Points around the antipode of the origin, where iterating on the longitude fails."""
    key = F.col("c_custkey")
    lat = F.lit(1.285) + (key % 211 - 105) / F.lit(100.0)
    lon = F.lit(-143.1742) + (key % 97 - 48) / F.lit(50.0)
    return table(spark, folder, "customer").select(
        "c_custkey",
        geo.geodesic_km(lat, lon, DEFAULTS.origin_lat, DEFAULTS.origin_lon).alias("km"),
    )


@query("f15_stable_id", "SELECT page_id, 'brk-' || substr(md5(url), 1, 12) AS id FROM pages")
def f15(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", parse.stable_id(F.col("url"), DEFAULTS.id_prefix).alias("id")
    )


@query(
    "f16_exact_decimals",
    """SELECT vec_id, CAST(list_sum(list_transform(embedding,
         lambda x: CAST(CAST(round(CAST(x AS DOUBLE), 6) AS DECIMAL(28,10)) AS DECIMAL(38,10)))) AS DOUBLE)
         AS total FROM embeddings""",
)
def f16(spark, folder):
    """Nested floats become exact decimals, which then add without error."""
    rounded_values = F.transform("embedding", lambda x: F.round(x.cast("double"), 6))
    exact = convert.floats_to_exact(
        table(spark, folder, "embeddings").select("vec_id", rounded_values.alias("embedding"))
    )
    total = F.aggregate(
        "embedding",
        F.lit(0).cast("decimal(38,10)"),
        lambda acc, x: (acc + x.cast("decimal(28,10)")).cast("decimal(38,10)"),
    )
    return exact.select("vec_id", total.alias("total"))


ODD_RECORDS = """(SELECT event_id, user_id, event_type, value, props ->> '$.k' AS k,
  CASE WHEN value = round(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END AS v
  FROM events)"""


@query(
    "f16_records_of_any_shape",
    f"""SELECT event_id,
      CASE event_type WHEN 'purchase' THEN value END AS price,
      CASE event_type WHEN 'purchase' THEN CAST(CAST(value AS DECIMAL(18,4)) + 0.25 AS DOUBLE) END AS parts,
      CASE event_type WHEN 'error' THEN user_id END AS code,
      CAST(k AS BIGINT) AS k,
      CASE event_type
        WHEN 'purchase' THEN '{{"amount":{{"parts":[' || v || ',0.25],"price":' || v || '}},"props":{{"k":' || k || '}}}}'
        WHEN 'error' THEN '{{"code":' || user_id || ',"props":{{"k":' || k || ',"note":null}}}}'
        WHEN 'click' THEN NULL
        ELSE '{{"props":{{"k":' || k || '}}}}' END AS stored
      FROM {ODD_RECORDS} WHERE event_type <> 'click'""",
)
def f16_any(spark, folder):
    """Events as records whose fields differ by their type, read without a schema. Clicks
    are sent as lists, which are no records."""
    value, props = F.col("value").cast("string"), F.col("props")
    sent = (
        F.when(F.col("event_type") == "purchase", F.concat(F.lit('{"props":'), props, F.lit(',"amount":{"price":'), value, F.lit(',"parts":['), value, F.lit(",0.25]}}")))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"code":'), "user_id", F.lit(',"props":{"note":null,"k":'), F.get_json_object("props", "$.k"), F.lit("}}")))
        .when(F.col("event_type") == "click", F.concat(F.lit("["), value, F.lit("]")))
        .otherwise(F.concat(F.lit('{"props":'), props, F.lit("}")))
    )
    read = records.with_record(table(spark, folder, "events"), sent).filter("record IS NOT NULL")
    both = read.withColumn("stored", records.stored_text())
    parts = F.aggregate(
        "record.amount.parts", F.lit(0).cast("decimal(38,4)"), lambda total, x: (total + x).cast("decimal(38,4)")
    )
    return records.typed(both).select(
        "event_id", F.col("record.amount.price").alias("price"), parts.alias("parts"),
        F.col("record.code").alias("code"), F.col("record.props.k").alias("k"), "stored",
    )


@query(
    "f17_expiry",
    "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) + 90 * 86400 AS expires_at FROM events",
)
def f17(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", dates.expiry_seconds(F.col("ts"), DEFAULTS.expiry_days).alias("expires_at")
    )


@query(
    "f18_json_round_trip",
    "SELECT event_id, CAST(props ->> '$.k' AS INT) AS k, '{\"k\":' || (props ->> '$.k') || '}' AS props FROM events",
)
def f18(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.from_json("props", "k int").alias("parsed")
    )
    return events.select("event_id", "parsed.k", F.to_json("parsed").alias("props"))


@query(
    "f19_partition_values",
    """SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour,
       replace('shard:' || user_id || ':' || event_id, ':', '-') AS file_key FROM events""",
)
def f19(spark, folder):
    return (
        table(spark, folder, "events")
        .withColumns(dates.archive_partitions(F.col("ts")))
        .withColumn(
            "file_key",
            text.key_safe(F.concat_ws(":", F.lit("shard"), "user_id", "event_id")),
        )
        .select("event_id", "year", "month", "day", "hour", "file_key")
    )
