"""Writing an intermediate result once, so several readers share it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rentlens.session import shared_folder


def spool(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet in the shared folder and return a scan of it.

    It cuts lineage with files that outlive lost executors, gives later readers
    column pruning, and gives the planner the true size, so a join with the
    result is broadcast only when its files are below the broadcast threshold.
    """
    spark = df.sparkSession
    path = f"{spool_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spool_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/spool/{spark.sparkContext.applicationId}"


def clear_spool(spark: SparkSession) -> None:
    """Delete what this application spooled, once its results are stored."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(spool_folder(spark))
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
