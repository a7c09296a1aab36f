"""Row filters and projections the models share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, REQUIRED_FIELDS, Settings
from rentlens.schema import NUMERIC_CASTS


def is_usable(s: Settings = DEFAULTS) -> Column:
    """Has an id and a location, and a plausible price."""
    return (
        F.col("property_id").isNotNull()
        & (F.trim("property_id") != "")
        & F.col("location_raw").isNotNull()
        & F.col("price_ksh").between(s.min_price, s.max_price)
    )


def quality_gate(df: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    return df.filter(is_usable(s))


def missing_fields(required: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """Names of the required fields that are absent or empty."""
    flags = F.array(
        *[
            F.when(F.coalesce(F.col(name).cast("string"), F.lit("")) == "", F.lit(name))
            for name in required
        ]
    )
    return F.filter(flags, lambda name: name.isNotNull())


def split_required(
    df: DataFrame, required: Sequence[str] = REQUIRED_FIELDS
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the reason."""
    checked = df.withColumn("_missing", missing_fields(required))
    accepted = checked.filter(F.size("_missing") == 0).drop("_missing")
    rejected = (
        checked.filter(F.size("_missing") > 0)
        .withColumn(
            "error",
            F.concat(F.lit("Missing required fields: "), F.concat_ws(", ", "_missing")),
        )
        .drop("_missing")
    )
    return accepted, rejected


def not_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) != "")


def with_group(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def chartable(df: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Rows with both axes, without extreme outliers."""
    return df.filter(
        F.col("dist_to_archives_km").isNotNull() & (F.col("price_ksh") > s.outlier_floor)
    )


def supported(stats: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    return stats.filter(F.col("total_listings") >= s.min_support)


def recent(df: DataFrame, stamp: str, asof: Column, hours: int) -> DataFrame:
    return df.filter(F.col(stamp) >= asof - F.expr(f"INTERVAL {int(hours)} HOURS"))


def cast_columns(df: DataFrame) -> DataFrame:
    """Numeric columns by `try_cast`: unreadable text becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in NUMERIC_CASTS.items()})


def top_ranked(df: DataFrame, rank: str, k: int, tie_breaker: str) -> DataFrame:
    """One row at rank k; the tie-breaker decides among equals."""
    return df.filter(F.col(rank) == k).orderBy(tie_breaker).limit(1)
