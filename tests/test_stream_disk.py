"""What stream jobs leave on disk."""

from __future__ import annotations

import base64
import json
import time
from pathlib import Path

from pyspark.sql import functions as F

from rentlens.operators.spool import spool_folder
from rentlens.registry import streams
from rentlens.schema import ENVELOPE
from rentlens.session import RELEASE, shuffles_released
from rentlens.sources import envelope, tables
from rentlens.streaming import ingest


def stamp():
    return F.lit("2026-03-04 05:06:07").cast("timestamp_ntz")


def packed(i):
    body = json.dumps(dict(property_id=f"p{i % 700}", scraped_at="2026-01-01T00:00:00+00:00", title="a house of stone " * 9, price_ksh=i))
    return {"event_id": f"shard-0:{i}", "data": base64.b64encode(body.encode()).decode(), "seq": str(i), "arrival": 1.7e9 + i}


def inbox(path, n=2000):
    path.mkdir()
    (path / "1.json").write_text("\n".join(json.dumps(packed(i)) for i in range(n)))
    return str(path)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().endswith(".data")}


def test_archive_is_compressed(spark, tmp_path):
    source, archive = inbox(tmp_path / "in"), str(tmp_path / "archive")
    query = ingest.start_archive(ingest.envelope_stream(spark, source), archive, str(tmp_path / "c"), stamp=stamp())
    query.awaitTermination()
    files = list(Path(archive).rglob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) * 4 < (tmp_path / "in" / "1.json").stat().st_size
    rows = tables.read_archive(spark, archive)
    assert rows.count() == 2000 and rows.agg(F.sum("price_ksh")).first()[0] == sum(range(2000))


def test_batches_release_their_shuffles(spark, tmp_path):
    stream = ingest.envelope_stream(spark, inbox(tmp_path / "in"))
    before = shuffle_files(spark)
    ingest.start_history(stream, str(tmp_path / "h"), str(tmp_path / "c"), asof=stamp()).awaitTermination()
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert ingest.history_table(spark, str(tmp_path / "h")).read().count() == 700
    assert spark.conf.get(RELEASE, "false") == "false"


def test_release_is_undone_after_a_failure(spark):
    try:
        with shuffles_released(spark):
            assert spark.conf.get(RELEASE) == "true"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(RELEASE, "false") == "false"


def test_text_is_parsed_once(spark):
    rows = spark.createDataFrame([tuple(packed(1)[c] for c in ENVELOPE.fieldNames())], ENVELOPE)
    plan = envelope.valid_rows(envelope.decode(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def deliveries(spark, folder):
    """Two hundred deliveries of thirty listings, as tables of the driver's names."""
    spark.createDataFrame([(0, "kenya", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "africa")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    spark.range(30).select(
        F.col("id").alias("c_custkey"), F.lit("name").alias("c_name"), F.lit(0).alias("c_nationkey"),
        F.lit(1.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"),
    ).write.parquet(f"{folder}/customer.parquet")
    day = F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(CAST(id AS INT))")
    spark.range(200).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 30).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        (F.col("id") * 1000.0 + 90000).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1").alias("o_orderpriority"),
    ).write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def kept(spark, name):
    at = Path(spool_folder(spark).removeprefix("file:")) / "registry"
    return {p for p in at.glob(f"{name}-*")}


def test_read_envelopes_go(spark, tmp_path):
    folder = deliveries(spark, tmp_path)
    before = kept(spark, "envelopes") | kept(spark, "turns")
    good = [i for i in range(200) if i % 97 != 5 and i % 101 != 7]
    rows = streams.st5(spark, folder)
    assert not (kept(spark, "envelopes") | kept(spark, "turns")) - before
    assert rows.count() == len({(i % 30, "junk" if i % 211 == 0 else i) for i in good})
    at = streams.whole_flow(spark, folder)
    assert not kept(spark, "envelopes") - before
    assert spark.read.parquet(at["landed"]).count() > 0


def test_small_batches_without_a_shuffle_of_envelopes(spark, tmp_path):
    folder = deliveries(spark, tmp_path)
    before, marks = kept(spark, "envelopes"), kept(spark, "checkpoints")
    assert streams.st6(spark, folder).count() == len([i for i in range(200) if i % 97 != 5 and i % 101 != 7])
    (path,) = kept(spark, "envelopes") - before
    assert len(list(path.glob("part-*.json.gz"))) >= 6
    (mark,) = kept(spark, "checkpoints") - marks
    assert len([p for p in (mark / "commits").iterdir() if p.name.isdigit()]) >= 3


def test_two_consumers_leave_no_envelopes(spark, tmp_path):
    folder = deliveries(spark, tmp_path)
    before, archives = kept(spark, "envelopes"), kept(spark, "archive")
    counts = {r["consumer"]: r["n"] for r in streams.st1(spark, folder).collect()}
    assert counts["archive"] == counts["history"] == len([i for i in range(200) if i % 97 != 5 and i % 101 != 7])
    assert not kept(spark, "envelopes") - before
    (archive,) = kept(spark, "archive") - archives
    assert all(f.name.endswith(".gz") for f in archive.rglob("part-*"))
