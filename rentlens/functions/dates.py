"""Dates and times. Timestamps carry no zone and mean UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def utc_timestamp(text: Column) -> Column:
    """ISO text, offset honoured, to a UTC timestamp; unreadable text is null."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def timestamp_by_pattern(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def to_zone(ts: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def utc_day(text: Column) -> Column:
    return utc_timestamp(text).cast("date")


def now_utc() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def hours_before(asof: Column, hours: int) -> Column:
    return asof - F.expr(f"INTERVAL {int(hours)} HOURS")


def expiry_seconds(asof: Column, days: int) -> Column:
    return F.unix_timestamp(asof.cast("timestamp")) + F.lit(days * 86_400)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from `start` up to but not including `end`."""
    days = (end - start).days
    return spark.range(days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day")
    )


def archive_partitions(ts: Column) -> dict[str, Column]:
    """Zero-padded year, month, day and hour, as used in archive paths."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }
