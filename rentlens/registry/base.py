"""Registration of queries, and the frames they start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.operators.spool import spool
from rentlens.plans import enriched as enriched_plan
from rentlens.plans import gold, marts, staging
from rentlens.schema import LANDED
from rentlens.session import prepare
from rentlens.sources import driver_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with its SQL where SQL can express it."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(build(prepare(spark), folder))

        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def portable(df: DataFrame) -> DataFrame:
    """Types every SQL engine returns alike: decimals as doubles, days and
    timestamps as text."""

    def plain(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        return col.alias(field.name)

    return df.select([plain(f) for f in df.schema.fields])


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return driver_tables.listings(spark, folder)


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """The columns that a landed table has, and no other."""
    return raw(spark, folder).select(LANDED.fieldNames())


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return spool(staging.staged_listings(landed(spark, folder)))


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enriched_plan.enriched_listings(staged(spark, folder))


# What the statistics read of a staged listing.
STATS_INPUT = [
    "neighbourhood", "latitude", "longitude", "dist_to_archives_km", "value_zone",
    "price_ksh", "bedrooms", "scraped_date",
]


def stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = spool(staging.staged_listings(landed(spark, folder)).select(STATS_INPUT))
    return marts.stats_rows(
        enriched_plan.enriched_listings(rows), asof(spark, folder)
    )


def finder(spark: SparkSession, folder: str) -> DataFrame:
    return marts.finder_rows(stats(spark, folder))


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Every day the orders cover."""
    start, end = gold.covering_dates(
        driver_tables.table(spark, folder, "orders").select(
            F.col("o_orderdate").cast("date").alias("day")
        ),
        "day",
    )
    return gold.date_dimension(spark, start, end)


def asof(spark: SparkSession, folder: str) -> Column:
    """The newest arrival stands in for the present, so results repeat."""
    newest = (
        driver_tables.table(spark, folder, "orders").agg(F.max("o_orderdate")).first()[0]
    )
    return F.lit(newest.isoformat(sep=" ")).cast("timestamp_ntz")
