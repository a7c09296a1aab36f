"""Whitening of embeddings with distributed block matrices.

Entries become whole numbers (floor of 64 c, shifted), so sums over all rows are exact.
Rows get numbers without gaps from the counts of their partitions; the centred rows form a
`BlockMatrix`, whose transpose times itself is the scatter, the middle dimension split so
that every block of rows is multiplied where it lies and only sums of d x d travel. The
driver holds d x d numbers and one count for each partition. The centred rows times the
whitening matrix are the projections.

A block matrix numbers rows with 32 bits, and its driver knows where each block lies;
input partitions are therefore put together to panels of at most `PANEL_ROWS` rows, each
with a block matrix of its own, whose scatters add up.

Defined results: rows whose vector is null or has a null, NaN or infinite entry take no
part. Neither do vectors of another length than the commonest (the longer of equally
common ones), nor empty vectors. Repeated rows and null ids give rows of their own. A
component whose eigenvalue is zero up to rounding has no whitened values and is left out,
so a single vector and an empty table give no rows. `deviation` is null where it does not
fit 64 bits. Entries must be below 2^56 in size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.operators.spool import spool

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK_ROWS, BLOCK_COLS = 1024, 1024
PANEL_ROWS = 1 << 26
SHAPE = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


class Rows:
    """Numbered rows (vec_id, x) of one dimension: partitions in panels, counts, sums."""

    def __init__(self, table: DataFrame, panel_rows: int = PANEL_ROWS) -> None:
        stored = spool(placed(whole(table)))
        # One row for each input partition and length.
        counts = stored.groupBy("part", F.size("x").alias("d")).count().collect()
        lengths: dict[int, int] = {}
        for r in counts:
            lengths[r["d"]] = lengths.get(r["d"], 0) + r["count"]
        self.n, self.d = max(((n, d) for d, n in lengths.items()), default=(0, 0))
        if len(lengths) > 1:
            stored = spool(placed(stored.filter(F.size("x") == self.d).drop("part", "place")))
            counts = stored.groupBy("part").count().collect()
        begins, self.panels, done = [], [], 0
        for r in sorted(counts, key=lambda r: r["part"]):
            begins.append((r["part"], done))
            if not self.panels or done + r["count"] - self.panels[-1][2] > panel_rows:
                self.panels.append([r["part"], r["part"], done, 0])
            self.panels[-1][1] = r["part"]
            self.panels[-1][3] += r["count"]
            done += r["count"]
        begins = table.sparkSession.createDataFrame(begins or [(0, 0)], "part int, begin long")
        self.table = stored.join(begins, "part").select("vec_id", "x", "part", (F.col("begin") + F.col("place")).alias("index"))

    def sums(self) -> list[int]:
        """Exact sum of each dimension; partial sums leave a task."""
        found = self.table.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("s"))
        return [r["s"] for r in sorted(found.collect(), key=lambda r: r["i"])]


def placed(rows: DataFrame) -> DataFrame:
    """With the partition of each row and its place there, to be written at once."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumns({"part": F.spark_partition_id(), "place": place})


def whole(table: DataFrame) -> DataFrame:
    """vec_id and x of the rows whose vector takes part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.filter(F.col("embedding").isNotNull() & finite & (F.size("embedding") > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(vector, lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"),
    )


def block_matrix(rows: DataFrame, n: int, d: int) -> BlockMatrix:
    """`rows`: index from 0 to n - 1 and v, an array of d doubles."""
    vectors = rows.select("index", array_to_vector("v").alias("v"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), n, d)
    return indexed.toBlockMatrix(BLOCK_ROWS, min(d, BLOCK_COLS))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix. Every block of rows is a split of its own of the
    middle dimension: without that, all blocks would meet in one task."""
    turned = matrix.transpose()
    product = turned._java_matrix_wrapper.call(
        "multiply", matrix._java_matrix_wrapper._java_model, int(matrix.numRowBlocks)
    )
    return BlockMatrix(product, turned.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def projected(spark: SparkSession, matrix: BlockMatrix, by: np.ndarray) -> DataFrame:
    """index and w, the matrix times `by`, row by row."""
    step, (d, k) = matrix.colsPerBlock, by.shape
    blocks = [
        ((i // step, 0), Matrices.dense(len(by[i : i + step]), k, by[i : i + step].ravel(order="F").tolist()))
        for i in range(0, d, step)
    ]
    other = BlockMatrix(spark.sparkContext.parallelize(blocks, 1), step, k, d, k)
    product = matrix.multiply(other)
    rows = product._java_matrix_wrapper.call("toIndexedRowMatrix")
    found = callMLlibFunc("getIndexedRows", rows).toDF("index", "w")
    return MLUtils.convertVectorColumnsToML(found, "w").select("index", vector_to_array("w").alias("w"))


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and unit eigenvectors as columns, at most so many, of
    those that are not zero up to rounding; the largest entry of a vector is positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    limit = max(float(values.max(initial=0.0)), 0.0) * len(values) * np.finfo(float).eps * 4
    keep = np.flatnonzero(values > limit)[:most]
    values, vectors = values[keep], vectors[:, keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))]) if len(keep) else 1.0
    return values, vectors * signs


def whiten(table: DataFrame, most: int = COMPONENTS, panel_rows: int = PANEL_ROWS) -> DataFrame:
    """For every row of `table` (vec_id, embedding) that takes part and every component up
    to `most`: vec_id, component (from 1), n, deviation, whitened, explained, and
    identity_error, one value for all."""
    spark, rows = table.sparkSession, Rows(table, panel_rows)
    if not rows.n:
        return spark.createDataFrame([], SHAPE)
    n, d, sums = rows.n, rows.d, rows.sums()
    gaps = F.zip_with("x", F.lit(sums), lambda x, s: x * F.lit(n).cast("long") - s)
    centred = F.transform(gaps, lambda g: g.cast("double") / n)
    matrices = _matrices(rows.table.withColumn("v", centred), rows.panels, d)
    covariance = sum(scatter(m) for m in matrices) / n
    values, vectors = components(covariance, most)
    if not len(values):
        return spark.createDataFrame([], SHAPE)
    found = None
    for (_, _, begin, _), matrix in zip(rows.panels, matrices, strict=True):
        part = projected(spark, matrix, vectors / np.sqrt(values)).withColumn("index", F.col("index") + begin)
        found = part if found is None else found.unionByName(part)
    found = spool(found)
    error = identity_error(found, rows, len(values))
    trace = float(np.trace(covariance))
    squares = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: F.try_add(total, F.try_multiply(g, g)))
    explained = F.lit([float(v) / trace for v in values])
    each = rows.table.select("vec_id", "index", squares.alias("deviation")).join(found, "index")
    return each.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def identity_error(found: DataFrame, rows: Rows, k: int) -> float:
    """Largest entry of the covariance of the whitened rows, centred, minus the identity."""
    means = found.select(F.posexplode("w").alias("i", "w")).groupBy("i").agg(F.avg("w").alias("m")).collect()
    mean = F.lit([r["m"] for r in sorted(means, key=lambda r: r["i"])])
    ends = [begin + n for _, _, begin, n in rows.panels]
    total = np.zeros((k, k))
    for (_, _, begin, n), end in zip(rows.panels, ends, strict=True):
        part = found.filter((F.col("index") >= begin) & (F.col("index") < end))
        centred = part.select((F.col("index") - begin).alias("index"), F.zip_with("w", mean, _less).alias("v"))
        total += scatter(block_matrix(centred, n, k))
    return float(np.abs(total / rows.n - np.eye(k)).max())


def _less(a: Column, b: Column) -> Column:
    return a - b


def _matrices(rows: DataFrame, panels: Sequence[Sequence[int]], d: int) -> list[BlockMatrix]:
    found = []
    for first, last, begin, n in panels:
        part = rows.filter((F.col("part") >= first) & (F.col("part") <= last))
        found.append(block_matrix(part.select((F.col("index") - begin).alias("index"), "v"), n, d))
    return found
