from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from rentlens.streaming import ingest, measures


def start(rows, folder, name, files=1):
    stream = ingest.envelope_stream(rows.sparkSession, str(folder / "in"), files)
    return (
        ingest.observed(stream, "deliveries").writeStream.queryName(name).format("json")
        .option("path", str(folder / "out")).option("checkpointLocation", str(folder / "check"))
        .trigger(availableNow=True).start()
    )


def test_batches_of_a_query_over_restarts(spark, tmp_path):
    body = F.base64(F.when(F.col("id") % 4 == 0, "[").otherwise('{"property_id": "p"}').cast("binary"))
    rows = spark.range(40).select(
        F.concat(F.lit("s:"), "id").alias("event_id"), body.alias("data"), F.col("id").cast("string").alias("seq"),
        F.col("id").cast("double").alias("arrival"),
    )
    listener = measures.Measures(spark, str(tmp_path / "measures"))
    spark.streams.addListener(listener)
    try:
        for turn in range(2):
            rows.repartition(2).write.mode("append").json(str(tmp_path / "in"))
            running = start(rows, tmp_path, "letters")
            running.awaitTermination()
            listener.wait(str(running.runId))
    finally:
        spark.streams.removeListener(listener)
    assert not listener.ended and not listener.last
    batches = measures.progress(spark, str(tmp_path / "measures"))
    total = measures.totals(batches).collect()
    assert [(r["name"], r["batches"], r["skipped"], r["input_rows"]) for r in total] == [("letters", 4, 0, 80)]
    counts = batches.agg(measures.observed_total("deliveries", "records_ok"), measures.observed_total("deliveries", "records_error"))
    assert tuple(counts.first()) == (60, 20)
    # A report that is missing shows as a gap.
    assert measures.totals(batches.filter("batch_id <> 2")).first()["skipped"] == 1


def test_a_stalled_stream_turns_to_warn_and_error(spark, tmp_path):
    place = tmp_path / "query=q"
    place.mkdir()
    at = dt.datetime(2026, 3, 1, tzinfo=dt.UTC)
    # Batch 1 ran twice; batch 2 came later and brought nothing.
    for batch, run, hours, n in [(0, "a", 0, 5), (1, "a", 1, 4), (1, "b", 2, 6), (2, "b", 30, 0)]:
        stamp = (at + dt.timedelta(hours=hours)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
        row = {"query_id": "q", "run_id": run, "batch_id": batch, "stamp": stamp, "input_rows": n, "observed": {}}
        (place / f"{batch}-{run}.json").write_text(json.dumps(row))
    batches = measures.progress(spark, str(tmp_path))
    assert measures.totals(batches).first()["input_rows"] == 11

    def status(hours):
        asof = F.lit((at + dt.timedelta(hours=hours)).replace(tzinfo=None)).cast("timestamp")
        return measures.freshness(batches, asof).first()["status"]

    assert [status(h) for h in (3, 26, 28, 52)] == ["pass", "pass", "warn", "error"]
    assert measures.freshness(batches.filter("false"), F.lit("2026-03-01").cast("timestamp")).first()["status"] == "error"
