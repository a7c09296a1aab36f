"""What streams did, as a table that rules can read.

A listener writes one small file for each batch of each query to a shared folder: rows read,
state held, watermark, and what the query observes of its data. Files are named by query,
batch and run, so a replayed batch adds none that counts twice, and a table of a driver
that was lost goes on with the next one.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from rentlens.config import DEFAULTS, Settings
from rentlens.operators.dedupe import latest_per_key
from rentlens.quality import rules

PROGRESS = (
    "query_id string, run_id string, name string, batch_id long, stamp timestamp, input_rows long, "
    "state_rows long, state_bytes long, watermark timestamp, observed map<string,map<string,string>>"
)


class Measures(StreamingQueryListener):
    """Add with `spark.streams.addListener`, remove when the queries have ended."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.last: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        # A trigger without new data reports the last batch again.
        if p.numInputRows == 0 and self.last.get(str(p.runId)) == p.batchId:
            return
        self.last[str(p.runId)] = p.batchId
        row = {
            "query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId,
            "stamp": p.timestamp, "input_rows": p.numInputRows,
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "state_bytes": sum(s.memoryUsedBytes for s in p.stateOperators),
            "watermark": p.eventTime.get("watermark"),
            "observed": {k: {f: None if v is None else str(v) for f, v in r.asDict().items()} for k, r in p.observedMetrics.items()},
        }
        self._write(f"{self.path}/query={p.id}/{p.batchId}-{p.runId}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.last.pop(str(event.runId), None)
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, run_id: str, seconds: float = 60) -> None:
        """Until all that an ended run has reported is written; its end comes last."""
        if not self.ended.setdefault(run_id, threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of {run_id} reported within {seconds} s")
        del self.ended[run_id]

    def _write(self, path: str, text: str) -> None:
        context = self.spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()


def progress(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch of each query; of a batch that ran again, the last run."""
    rows = spark.read.schema(PROGRESS).json(f"{path}/*/*.json")
    return latest_per_key(rows, ["query_id", "batch_id"], ["stamp", "run_id"], stamps_differ=True)


def totals(batches: DataFrame) -> DataFrame:
    """For each query: its batches, those that no report tells of, rows and most state."""
    missing = F.max("batch_id") - F.min("batch_id") + 1 - F.count("*")
    return batches.groupBy("query_id").agg(
        F.max("name").alias("name"),
        F.count("*").alias("batches"),
        missing.alias("skipped"),
        F.sum("input_rows").alias("input_rows"),
        F.max("state_rows").alias("state_rows"),
        F.max("stamp").alias("newest"),
    )


def observed_total(name: str, metric: str) -> Column:
    """The sum of an observed count over all batches."""
    return F.sum(F.col("observed")[name][metric].cast("long"))


def freshness(batches: DataFrame, asof: Column, s: Settings = DEFAULTS) -> DataFrame:
    """Age of the newest batch that brought rows: pass, warn or error. No batch is an error."""
    return rules.freshness(batches.filter("input_rows > 0"), "stamp", asof, s.warn_hours, s.error_hours)
