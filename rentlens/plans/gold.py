"""Star schema: date and neighbourhood dimensions, listings fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.config import COMMUTE_TIERS, VALUE_ZONES
from rentlens.functions import classify, dates, numeric


def date_dimension(
    spark: SparkSession,
    start: dt.date = dt.date(2026, 1, 1),
    end: dt.date = dt.date(2027, 1, 1),
) -> DataFrame:
    """One row per day from start to before end. It is a range of known length, so
    the planner broadcasts it by size and no hint is needed."""
    day = F.col("date_day")
    return dates.calendar(spark, start, end).select(
        day,
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.trunc(day, "month").alias("month_start"),
        F.date_format(day, "MMMM").alias("month_name"),
        (F.dayofweek(day) - 1).alias("day_of_week_num"),
        F.upper(F.date_format(day, "EEE")).alias("day_name_short"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.date_format(day, "MMMM yyyy").alias("month_year"),
        dates.is_weekend(day).alias("is_weekend"),
    )


def covering_dates(df: DataFrame, column: str) -> tuple[dt.date, dt.date]:
    """Start and end (exclusive) of a calendar that covers a date column."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return dt.date(2026, 1, 1), dt.date(2027, 1, 1)
    return low, high + dt.timedelta(days=1)


def neighbourhood_dimension(enriched: DataFrame, asof: Column | None = None) -> DataFrame:
    return (
        enriched.dropna(subset=["neighbourhood"])
        .groupBy("neighbourhood")
        .agg(
            F.max("latitude").alias("latitude"),
            F.max("longitude").alias("longitude"),
            F.max("dist_to_archives_km").alias("dist_to_archives_km"),
            classify.max_label(F.col("commute_tier"), COMMUTE_TIERS).alias("commute_tier"),
            # The alphabetically last zone: zones vary within a neighbourhood.
            classify.max_label(F.col("value_zone"), VALUE_ZONES).alias("value_zone"),
            numeric.affordability(F.avg("price_ksh"), F.max("dist_to_archives_km")).alias(
                "affordability_index"
            ),
            F.count("*").alias("total_listings_count"),
            F.min("scraped_date").alias("first_listing_date"),
            F.max("scraped_date").alias("last_update_date"),
        )
        .withColumn("updated_at", asof if asof is not None else dates.now_utc())
    )


def listings_fact(enriched: DataFrame, asof: Column | None = None) -> DataFrame:
    """One row per listing, latest snapshot."""
    return enriched.dropna(subset=["neighbourhood", "scraped_date"]).select(
        "property_id",
        "scraped_date",
        "neighbourhood",
        F.col("price_ksh").cast("decimal(12,2)").alias("price_ksh"),
        F.col("price_vs_neighbourhood_median")
        .cast("decimal(10,4)")
        .alias("price_vs_neighbourhood_median"),
        "bedrooms",
        "bathrooms",
        "bedroom_label",
        "property_type",
        "price_bucket",
        "is_sweet_spot",
        "title",
        "source_url",
        "location_raw",
        "scraped_at_eat",
        "firehose_arrival_at",
        (asof if asof is not None else dates.now_utc()).alias("loaded_at"),
    )
