"""Connected components of very many links, by repeated contraction to stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators.spool import spool

#: Rows a task of a contraction takes, about: small graphs need few tasks.
TASK_ROWS = 250_000


def components(links: DataFrame) -> DataFrame:
    """`links` (a, b): for every node that has a link, node and root, the smallest node it
    reaches. Links of a node with itself are ignored, as are null ends.

    Each round points a node and all its neighbours to the smallest node among them, so a
    component becomes a star around its smallest node in about log(diameter) rounds. The
    minimum is taken before the shuffle; a node with very many links is one row on one
    side of the join, whose other side adaptive execution can split.
    """
    edges = spool(_pointing(links.select("a", "b")))
    tasks = max(8, edges.count() // TASK_ROWS)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = spool(both.groupBy("a").agg(F.min("b").alias("_m"), F.count("*").alias("_n")).coalesce(tasks))
        # In stars, a node with a smaller neighbour has no other.
        if lowest.filter("_m < a AND _n > 1").isEmpty():
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(lowest.filter("_m > a").select(F.col("a").alias("node"), F.col("a").alias("root")))
        met = both.join(lowest.select("a", F.least("a", "_m").alias("_m")), "a").coalesce(tasks)
        pairs = met.select(F.explode(F.array(F.struct("a", F.col("_m").alias("b")), F.struct(F.col("b").alias("a"), F.col("_m").alias("b")))).alias("p"))
        edges = spool(_pointing(pairs.select("p.a", "p.b")).coalesce(tasks))


def _pointing(pairs: DataFrame) -> DataFrame:
    """Different pairs, from the larger node to the smaller."""
    return (
        pairs.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
