"""Session settings the jobs rely on."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what jobs depend on: UTC days, a shared folder for spooled tables, and
    streaming state that may outgrow the heap."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary one only in local mode, where
    driver and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="rentlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def require_shared(spark: SparkSession) -> None:
    """Raise unless the driver sees what executors write into the shared folder. A job on
    a new cluster may ask once; it costs two small jobs."""
    path = f"{shared_folder(spark)}/probe-{uuid.uuid4().hex}"
    tasks = max(2, spark.sparkContext.defaultParallelism)
    try:
        spark.range(tasks, numPartitions=tasks).write.parquet(path)
        seen = spark.read.schema("id long").parquet(path).count()
    except Exception as error:
        raise ValueError(f"spark.checkpoint.dir is not shared: {error}") from error
    if seen != tasks:
        raise ValueError(f"spark.checkpoint.dir is not shared: {seen} of {tasks} rows seen")
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query that runs inside go when it ends, and not when the
    driver happens to collect its garbage. For queries that run once."""
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def build(app_name: str = "rentlens", cores: int | None = None) -> SparkSession:
    """A local session for tests and the benchmark."""
    return prepare(
        SparkSession.builder.master(f"local[{cores}]" if cores else "local[*]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cores or 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Plans are built from many small columns; call sites are not needed for them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
