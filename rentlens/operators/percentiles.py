"""Exact interpolated percentiles per group that survive a hot group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    points: Mapping[str, float],
    subset: Column | None = None,
    subset_points: Mapping[str, float] | None = None,
) -> DataFrame:
    """Percentiles of `value` per group, and of the rows where `subset` holds.

    Rows are first counted per (group, value), which spreads one large group
    over all tasks. The final step then sees each distinct value of a group
    once, with its count. Prices are whole numbers between the gate's bounds,
    so that list is bounded however many rows a group has.
    """
    flag = F.coalesce(subset, F.lit(False)) if subset is not None else F.lit(False)
    counted = (
        df.select(*keys, value.alias("_value"), flag.alias("_subset"))
        .groupBy(*keys, "_value", "_subset")
        .agg(F.count("*").alias("_n"))
    )
    picks = {"_all": (F.col("_value"), points)}
    if subset_points:
        picks["_some"] = (F.when(F.col("_subset"), F.col("_value")), subset_points)
    found = counted.groupBy(*keys).agg(
        *[
            F.percentile(col, list(wanted.values()), F.col("_n")).alias(name)
            for name, (col, wanted) in picks.items()
        ]
    )
    return found.select(
        *keys,
        *[
            F.col(name)[i].alias(alias)
            for name, (_, wanted) in picks.items()
            for i, alias in enumerate(wanted)
        ],
    )


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    return grouped_percentiles(df, keys, F.col(value), {alias: 0.5})
