"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(df: DataFrame, stamps: Sequence[str]) -> list[Column]:
    """Order by the stamps, newest first and null last, then by every other
    column, so that a tie is broken by content and never by arrival in a task.

    Sorting by many columns costs no more than by the stamps: the later ones are
    compared on ties only.
    """
    rest = [c for c in df.columns if c not in stamps]
    return [F.col(c).desc_nulls_last() for c in [*stamps, *rest]]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], stamps: Sequence[str], stamps_differ: bool = False
) -> DataFrame:
    """One row per key. The row_number = 1 filter lets the planner drop older
    rows before the shuffle, so one hot key sends one row per task.

    `stamps_differ` says that no two rows of a key share all stamps. Then the
    other columns take no part in the order, and those the query does not use
    are never read.
    """
    order = (
        [F.col(c).desc_nulls_last() for c in stamps]
        if stamps_differ
        else newest_first(df.drop(*keys), stamps)
    )
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_row", F.row_number().over(window))
        .filter(F.col("_row") == 1)
        .drop("_row")
    )


def latest_by_aggregate(df: DataFrame, keys: Sequence[str], stamps: Sequence[str]) -> DataFrame:
    """The same rows from an aggregate with partial maxima instead of a window.

    Null stamps must not exist here: a struct comparison sorts them first.
    """
    rest = [c for c in df.columns if c not in keys and c not in stamps]
    ordered = [*stamps, *rest]
    top = df.groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("_top"))
    return top.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in ordered]).select(df.columns)


def merge_latest(
    left: DataFrame, right: DataFrame, keys: Sequence[str], stamps: Sequence[str]
) -> DataFrame:
    """Reconcile two tables of one schema: the newest row of each key wins."""
    return latest_per_key(left.unionByName(right), keys, stamps)
