"""Q6 and Q8 kept up to date by loads, and S7 looked up in a stored table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.plans import staging
from rentlens.plans.price_counts import PriceCounts
from rentlens.registry import base
from rentlens.registry.base import query
from rentlens.registry.layers import over
from rentlens.registry.sources import scratch
from rentlens.sources import tables
from rentlens.sources.driver_tables import table


def after_loads(spark, folder, loads: int = 3) -> PriceCounts:
    """The histogram after loads of consecutive arrivals, each staged by itself."""
    rows = base.landed(spark, folder)
    at = F.unix_timestamp(F.col("firehose_arrival_at").cast("timestamp"))
    first, last = rows.agg(F.min(at), F.max(at)).first()
    counts = PriceCounts(spark, scratch(spark, "price_counts"))
    step = ((last - first) // loads + 1) if last is not None else 1
    for i in range(loads):
        part = rows.filter(F.floor((at - (first or 0)) / step) == i)
        counts.apply(staging.staged_listings(part), i + 1)
    return counts


RENTS = """count(*) AS total_listings, round(avg(price_ksh)) AS avg_rent_ksh, min(price_ksh) AS min_rent_ksh,
    max(price_ksh) AS max_rent_ksh, round(quantile_cont(price_ksh, 0.25)) AS p25_rent_ksh,
    round(quantile_cont(price_ksh, 0.5)) AS median_rent_ksh, round(quantile_cont(price_ksh, 0.75)) AS p75_rent_ksh,
    round(quantile_cont(price_ksh, 0.75)) - round(quantile_cont(price_ksh, 0.25)) AS iqr_rent_ksh,
    round(avg(price_ksh) FILTER (bedrooms = 1)) AS avg_1br_rent_ksh, count(*) FILTER (bedrooms = 1) AS listings_1br"""


@query(
    "q6_rents_after_loads",
    over("stg", f"SELECT neighbourhood, {RENTS} FROM stg WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood"),
)
def q6_after_loads(spark, folder):
    return after_loads(spark, folder).mart("neighbourhood")


@query(
    "q8_monthly_rents_after_loads",
    over(
        "stg",
        f"""SELECT neighbourhood, strftime(date_trunc('month', scraped_date), '%Y-%m-%d') AS month_start, {RENTS}
            FROM stg WHERE neighbourhood IS NOT NULL AND scraped_date IS NOT NULL GROUP BY ALL""",
    ),
)
def q8_after_loads(spark, folder):
    return after_loads(spark, folder).mart("neighbourhood", "month_start")


@query(
    "s7_point_lookup",
    over(
        "stg",
        """SELECT property_id, neighbourhood, price_ksh FROM stg
           WHERE property_id IN (SELECT 'brk-' || max(c_custkey) FROM customer GROUP BY c_nationkey)""",
    ),
)
def s7_lookup(spark, folder):
    """The latest price of one listing of each nation, the feature being a lookup by key."""
    path = scratch(spark, "lookups")
    rows = staging.staged_listings(base.landed(spark, folder))
    tables.write_lookups(rows.select("property_id", "neighbourhood", "price_ksh"), path, "property_id", "neighbourhood")
    newest = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.max("c_custkey").alias("c"))
    return tables.look_up(spark.read.parquet(path), "property_id", [f"brk-{r['c']}" for r in newest.collect()])
