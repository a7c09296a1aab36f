"""Global RANK with nulls last."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.operators.spool import spool


@dataclass(frozen=True)
class RankBy:
    alias: str
    column: str
    descending: bool = False

    def order(self, value: str) -> Column:
        col = F.col(value)
        return col.desc_nulls_last() if self.descending else col.asc_nulls_last()


def with_ranks(df: DataFrame, ranks: Sequence[RankBy]) -> DataFrame:
    """Add one global rank per entry, taken over range partitions at any size: a global
    window would sort all rows in one task.

    All rankings are stacked: a row per ranking and distinct value, with its count, so ties
    cost one row. One range shuffle orders them all. Rank = rows in earlier ranges of the
    ranking + rows before the value in its own range + 1. The frame is spooled because its
    rows and the range bounds must not change between reads.
    """
    base = spool(df.withColumn("_row", F.monotonically_increasing_id()))
    kinds = {f.name: f.dataType for f in base.schema.fields}

    def entry(i: int, r: RankBy) -> Column:
        # Each ranking has a field of its own type; those of the others are null.
        values = [
            (F.col(x.column) if j == i else F.lit(None).cast(kinds[x.column])).alias(f"v{j}")
            for j, x in enumerate(ranks)
        ]
        return F.struct(F.lit(i).alias("_ranking"), F.struct(*values).alias("_key"))

    stacked = base.select(
        "_row", F.inline(F.array(*[entry(i, r) for i, r in enumerate(ranks)]))
    )
    values = stacked.groupBy("_ranking", "_key").agg(F.count("*").alias("_n"))
    order = [r.order(f"_key.v{i}") for i, r in enumerate(ranks)]
    # The part number is taken while rows still lie where the range shuffle put them.
    ranged = spool(
        values.repartitionByRange(F.col("_ranking").asc(), *order).withColumn(
            "_part", F.spark_partition_id()
        )
    )
    # One row per range and ranking: as many as there are shuffle partitions, about.
    totals = ranged.groupBy("_ranking", "_part").agg(F.sum("_n").alias("_total"))
    before = Window.partitionBy("_ranking").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_ranking", "_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start")
    )
    within = (
        Window.partitionBy("_ranking", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = (
        ranged.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(starts, ["_ranking", "_part"])
        .select("_ranking", "_key", (F.col("_start") + F.col("_before") + 1).alias("_rank"))
    )
    found = stacked.join(ranked, ["_ranking", "_key"]).groupBy("_row").agg(
        *[F.max(F.when(F.col("_ranking") == i, F.col("_rank"))).alias(r.alias) for i, r in enumerate(ranks)]
    )
    return base.join(found, "_row").drop("_row")


def with_positions(df: DataFrame, alias: str, *order: Column) -> DataFrame:
    """Add each row's place in a total order: the rows of earlier ranges, and its place
    in its own range. No task sorts more than a range."""
    ranged = spool(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        ranged.join(starts, "_part")
        .withColumn(alias, F.col("_start") + within)
        .drop("_part", "_start")
    )
