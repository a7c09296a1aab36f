"""Gates that stop a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, Settings


class QualityError(RuntimeError):
    """A rule of severity error failed."""


def halt_on_failure(report: DataFrame | list[dict], stage: str) -> None:
    """Raise with the failed rules. A report has one row per rule."""
    lines = report if isinstance(report, list) else [r.asDict() for r in report.collect()]
    failed = [r for r in lines if r["status"] == "fail"]
    if failed:
        rules = "; ".join(f"{r['layer']}: {r['rule']} ({r['failed']})" for r in failed)
        raise QualityError(f"halted at {stage}: {len(failed)} rule(s) failed: {rules}")


def fresh_counts(
    streamed: DataFrame, batch: DataFrame, asof: Column, s: Settings = DEFAULTS
) -> DataFrame:
    """Recent rows of both inputs, and whether the gate is open."""
    window = F.expr(f"INTERVAL {s.gate_hours} HOURS")
    stream_count = streamed.agg(
        F.count_if(F.col("firehose_arrival_at") >= asof - window).alias("stream_count")
    )
    batch_count = batch.agg(
        F.count_if(F.col("batch_cleaned_at") >= asof - window).alias("batch_count")
    )
    return stream_count.select(
        "stream_count", batch_count.scalar().alias("batch_count")
    ).withColumn("is_open", (F.col("stream_count") > 0) & (F.col("batch_count") > 0))


def require_fresh(
    streamed: DataFrame, batch: DataFrame, asof: Column, s: Settings = DEFAULTS
) -> None:
    counts = fresh_counts(streamed, batch, asof, s).first()
    if not counts["is_open"]:
        raise QualityError(
            f"stale input: stream rows {counts['stream_count']}, batch rows {counts['batch_count']}"
        )
