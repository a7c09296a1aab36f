"""Files and catalog tables in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.functions.dates import archive_partitions
from rentlens.schema import CANONICAL, LOOKUP, RAW_RECORD

ARCHIVE_PARTITIONS = ["year", "month", "day", "hour"]


def archive_schema(payload: T.StructType = CANONICAL) -> T.StructType:
    """Payload, delivery metadata, and the partition values kept as padded text."""
    extra = [
        T.StructField("_shard", T.StringType()),
        T.StructField("_seq", T.StringType()),
        T.StructField("_arrival", T.DoubleType()),
    ]
    parts = [T.StructField(p, T.StringType()) for p in ARCHIVE_PARTITIONS]
    return T.StructType([*payload.fields, *extra, *parts])


def read_archive(
    spark: SparkSession, path: str, payload: T.StructType = CANONICAL
) -> DataFrame:
    """The NDJSON archive. Filters on the partition columns prune directories."""
    return spark.read.schema(archive_schema(payload)).json(path)


def write_archive(
    rows: DataFrame,
    path: str,
    stamp: Column,
    mode: str = "append",
    files_per_hour: int | None = None,
) -> None:
    """One NDJSON directory per hour of `stamp`.

    Rows of many hours leave a file per task and hour; `files_per_hour` deals each
    hour's rows to that many tasks instead, so a busy hour is still spread out.
    """
    parted = rows.withColumns(archive_partitions(stamp))
    if files_per_hour:
        deal = F.pmod(F.xxhash64(*rows.columns), F.lit(files_per_hour))
        parted = parted.repartition(*ARCHIVE_PARTITIONS, deal)
    parted.write.mode(mode).partitionBy(*ARCHIVE_PARTITIONS).json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A batch file holding a JSON array of raw records."""
    return spark.read.schema(RAW_RECORD).option("multiLine", True).json(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The resolution cache. `inserted` orders rows by file age, then by place in
    the file: the first row of a text wins."""
    rows = spark.read.schema(LOOKUP).option("header", True).csv(path)
    return rows.select(
        *LOOKUP.fieldNames(),
        F.struct(
            F.col("_metadata.file_modification_time"),
            F.col("_metadata.file_name"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("inserted"),
    )


def append_lookup(resolved: DataFrame, path: str) -> None:
    """Add a batch of new resolutions in one write."""
    (
        resolved.select(LOOKUP.fieldNames())
        .write.mode("append")
        .option("header", True)
        .csv(path)
    )


def publish(
    df: DataFrame,
    name: str,
    kind: str = "view",
    path: str | None = None,
    sort_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Make a layer readable by name: a lazy view, or a stored table.

    `sort_by` clusters rows for the Parquet statistics, `bucket_by` stores them
    hashed on a join key, `spread` deals them evenly over that many files.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind != "table":
        raise ValueError(f"unknown kind {kind!r}")
    if spread:
        df = df.repartition(spread)
    if sort_by and not bucket_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if bucket_by:
        buckets, key = bucket_by
        writer = writer.bucketBy(buckets, key)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(name)
    return spark.table(name)


def buckets_for(df: DataFrame, bytes_each: int = 128 << 20, least: int = 8) -> int:
    """Buckets that hold about so many bytes each, by the planner's estimate."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(least, -(-size // bytes_each))


def column_listing(spark: SparkSession, name: str) -> DataFrame:
    """Name, type and position of each column of a table or view."""
    columns = spark.catalog.listColumns(name)
    return spark.createDataFrame(
        [(c.name, c.dataType, i) for i, c in enumerate(columns, start=1)],
        "column_name string, data_type string, ordinal_position int",
    )


#: Bytes of a table for lookups that are skipped or read together.
LOOKUP_BLOCK = 16 << 20


def write_lookups(
    df: DataFrame, path: str, key: str, cluster: str, block_bytes: int = LOOKUP_BLOCK, distinct: int = 1 << 17
) -> None:
    """Store a table so that a lookup reads few blocks: rows lie in ranges of `cluster`,
    whose statistics rule blocks out, and every block has a Bloom filter of `key`, made for
    so many distinct keys. The key's dictionary would be as long as the block."""
    (
        df.repartitionByRange(cluster, key)
        .sortWithinPartitions(cluster, key)
        .write.option("parquet.block.size", block_bytes)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", distinct)
        .option(f"parquet.enable.dictionary#{key}", "false")
        .parquet(path)
    )


def look_up(stored: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows with some values. They are written as single comparisons, which the scan hands
    to statistics and Bloom filters; a long list would become a range."""
    wanted = F.lit(False)
    for value in values:
        wanted = wanted | (F.col(column) == value)
    return stored.filter(wanted)
