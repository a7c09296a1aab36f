"""Listings derived from a star-schema order table.

Gives every job real rows at any scale: one delivery per order, one listing per
customer, one neighbourhood per nation. It contains what the models must handle:
repeated deliveries, blanks, padding, out-of-range values, missing distances,
implausible prices and unreadable timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Stated, so that no job runs to read schemas.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
        "props string"
    ),
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Landed listings: the canonical columns, `firehose_arrival_at` and the
    delivery number `arrival_seq`."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"
    )
    customer = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_name"
    )
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key, nkey, okey = F.col("o_custkey"), F.col("n_nationkey"), F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date").cast("string")
    divisor = (
        F.when(nkey % 4 == 0, 4).when(nkey % 4 == 1, 8).when(nkey % 4 == 2, 16).otherwise(24)
    )
    price = (
        F.when(nkey == 7, F.lit(25000))
        .otherwise(F.floor(F.col("o_totalprice") / divisor).cast("int"))
    )
    return joined.select(
        F.concat(F.lit("brk-"), key.cast("string")).alias("property_id"),
        F.when(okey % 211 == 0, F.lit("junk"))
        .otherwise(F.concat(day, F.lit("T22:30:00+00:00")))
        .alias("scraped_at"),
        F.concat(F.lit("https://listings.example/"), key.cast("string")).alias("source_url"),
        F.concat_ws(", ", "n_name", "r_name").alias("location_raw"),
        F.when(key % 50 == 0, None)
        .when(key % 97 == 1, F.concat(F.lit(" solo"), key.cast("string")))
        .otherwise(F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
        .alias("neighbourhood"),
        ((nkey + 300) / F.lit(-250.0)).alias("latitude"),
        ((nkey + 9200) / F.lit(250.0)).alias("longitude"),
        F.when(key % 41 == 0, None)
        .otherwise((F.lit(600) + nkey * 850 + (key % 10) * 13) / F.lit(1000.0))
        .alias("dist_to_archives_km"),
        F.concat(F.lit("KSh "), F.format_number(price, 0), F.lit(" per month")).alias("price_raw"),
        price.alias("price_ksh"),
        ((key % 7).cast("int") - 1).alias("bedrooms"),
        (okey % 13).cast("int").alias("bathrooms"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("  "))
        .otherwise(F.col("c_mktsegment"))
        .alias("property_type"),
        F.col("c_name").alias("title"),
        F.concat(
            day,
            F.lit("T23:"),
            F.lpad((okey % 60).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad((F.floor(okey / 60) % 60).cast("string"), 2, "0"),
            F.lit("+00:00"),
        ).alias("ingested_at"),
        F.col("o_orderdate").alias("firehose_arrival_at"),
        okey.alias("arrival_seq"),
    )
