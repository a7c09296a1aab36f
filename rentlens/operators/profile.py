"""One-pass summaries of a table or a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame) -> DataFrame:
    """One row: size, distinct groups, arrival range and missing prices."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("neighbourhood").alias("distinct_neighbourhoods"),
        F.min("firehose_arrival_at").alias("earliest_record"),
        F.max("firehose_arrival_at").alias("latest_record"),
        F.count_if(F.col("price_ksh").isNull()).alias("null_prices"),
    )


def run_summary(df: DataFrame, skipped: Column, failed: Column) -> DataFrame:
    """One row: records in, sent, failed and skipped. A skipped record cannot fail."""
    skip = F.coalesce(skipped, F.lit(False))
    fail = ~skip & F.coalesce(failed, F.lit(False))
    return df.agg(
        F.count("*").alias("total_scraped"),
        F.count_if(~skip & ~fail).alias("posted_ok"),
        F.count_if(fail).alias("failed"),
        F.count_if(skip).alias("skipped"),
    )
