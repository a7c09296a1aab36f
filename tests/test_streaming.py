from __future__ import annotations

import base64
import json

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from rentlens.config import Settings
from rentlens.schema import CANONICAL, ENVELOPE, LANDED
from rentlens.sources import envelope, tables
from rentlens.streaming import ingest


def stamp():
    return F.lit("2026-03-04 05:06:07").cast("timestamp_ntz")


def packed(record, seq, data=None):
    body = record if isinstance(record, str) else json.dumps(record)
    return {
        "event_id": f"shard-0:{seq}",
        "data": base64.b64encode(body.encode()).decode() if data is None else data,
        "seq": str(seq),
        "arrival": 1_700_000_000.0 + seq,
    }


def record(i, price=10000, at="2026-01-01T00:00:00+00:00", **more):
    return dict(property_id=i, scraped_at=at, price_ksh=price, location_raw="Ngära", **more)


def write(folder, name, envelopes):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(e) for e in envelopes))


def run(query):
    query.awaitTermination()
    return query


def test_decode(spark):
    rows = [
        packed(record("a"), 1),
        packed("[1, 2", 2),
        packed("null", 3),
        packed("5", 4),
        packed({}, 5, data="%% no base64 %%"),
        packed({}, 6, data=base64.b64encode(b"\xff\xfe{").decode()),
        packed({}, 7, data=""),
        packed(record("h", price="not a number", bedrooms=1.0), 8),
    ]
    df = spark.createDataFrame([tuple(r[c] for c in ENVELOPE.fieldNames()) for r in rows], ENVELOPE)
    decoded = envelope.decode(df)
    valid = {r["_seq"]: r for r in envelope.valid_rows(decoded).collect()}
    assert set(valid) == {"1", "8"}
    assert valid["1"]["location_raw"] == "Ngära" and valid["1"]["_shard"] == "shard-0"
    # One unreadable field costs the field, not the record.
    assert valid["8"]["price_ksh"] is None and valid["8"]["property_id"] == "h"
    assert sorted(r["seq"] for r in envelope.dead_letters(decoded).collect()) == list("234567")
    assert envelope.delivery_counts(decoded).first().asDict() == {
        "records_ok": 2, "records_error": 6,
    }


def test_history_keeps_the_last_write_over_batches_and_replays(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "history")
    first, second = "2026-01-01T00:00:00+00:00", "2026-01-02T00:00:00+00:00"
    write(source, "1.json", [
        packed(record("a", 1), 9), packed(record("a", 2), 10), packed(record("a", 5, second), 11),
        packed(record(None), 12), packed("junk", 13),
    ])
    stream = ingest.envelope_stream(spark, str(source))
    run(ingest.start_history(stream, path, str(tmp_path / "c1"), stamp()))
    write(source, "2.json", [packed(record("a", 3, second), 14), packed(record("b", 4), 15)])
    run(ingest.start_history(stream, path, str(tmp_path / "c1"), stamp()))

    def prices():
        rows = ingest.history_table(spark, path).read().collect()
        return sorted((r["property_id"], r["scraped_date"], r["price_ksh"]) for r in rows)

    # Sequence 10 is later than 9 although its text sorts before.
    want = [("a", first, 2), ("a", second, 3), ("b", first, 4)]
    assert prices() == want

    # The second batch again, as after a crash before its commit.
    rows = spark.read.schema(ENVELOPE).json(str(source / "2.json"))
    valid = envelope.valid_rows(envelope.decode(rows))
    replayed = [c.key for c in ingest.history_table(spark, path).commits()][-1]
    ingest.history_table(spark, path).upsert(ingest.history_rows(valid, stamp()), replayed)
    assert prices() == want

    history = ingest.history_table(spark, path).read()
    latest = {r["property_id"]: r["price_ksh"] for r in ingest.latest_state(history).collect()}
    assert latest == {"a": 3, "b": 4}
    assert ingest.unexpired(history, stamp()).count() == 3
    later = F.lit("2026-06-04 05:06:07").cast("timestamp_ntz")
    assert ingest.unexpired(history, later).count() == 0
    counts = spark.read.json(f"{path}_counts").orderBy("batch_id").collect()
    assert [(r["processed"], r["failed"]) for r in counts] == [(3, 2), (2, 0)]


def test_history_survives_a_new_checkpoint_and_is_folded(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "history")
    for i in range(4):
        write(source, f"{i}.json", [packed(record(f"p{i}", i), i), packed(record("all", i), 100 + i)])
    settings = Settings(history_commits=2)
    for checkpoint, files in (("c1", 4), ("c2", 1)):
        stream = ingest.envelope_stream(spark, str(source), files)
        run(ingest.start_history(stream, path, str(tmp_path / checkpoint), stamp(), settings))
    table = ingest.history_table(spark, path)
    assert sorted(r["property_id"] for r in table.read().collect()) == ["all", "p0", "p1", "p2", "p3"]
    assert len(table.commits()) <= 3
    assert spark.read.json(f"{path}_counts").count() == 5


def test_batch_without_a_valid_record_fails_and_is_read_again(spark, tmp_path):
    source, letters = tmp_path / "in", str(tmp_path / "letters")
    write(source, "1.json", [packed("junk", 1), packed("[", 2)])
    stream = ingest.envelope_stream(spark, str(source))
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="none of 2 records"):
            run(ingest.start_dead_letters(stream, letters, str(tmp_path / "c")))
    assert not (tmp_path / "letters").exists()


def test_dead_letters_are_kept(spark, tmp_path):
    source, letters = tmp_path / "in", str(tmp_path / "letters")
    write(source, "1.json", [packed("junk", 1), packed(record("a"), 2)])
    stream = ingest.envelope_stream(spark, str(source))
    run(ingest.start_dead_letters(stream, letters, str(tmp_path / "c")))
    kept = spark.read.schema(ENVELOPE).json(f"{letters}/letters").collect()
    assert [r["seq"] for r in kept] == ["1"]
    assert spark.read.json(f"{letters}/counts").first()["records_ok"] == 1


def test_archive_then_landed_once(spark, tmp_path):
    source, archive, landed = tmp_path / "in", str(tmp_path / "archive"), str(tmp_path / "landed")
    write(source, "1.json", [packed(record("a"), 1), packed("junk", 2)])
    stream = ingest.envelope_stream(spark, str(source))

    def step():
        run(ingest.start_archive(stream, archive, str(tmp_path / "ca"), stamp=stamp()))
        run(ingest.start_landing(spark, archive, landed, str(tmp_path / "cl")))
        return spark.read.schema(LANDED).parquet(landed).collect()

    assert [r["property_id"] for r in step()] == ["a"]
    assert [r["property_id"] for r in step()] == ["a"]
    write(source, "2.json", [packed(record("b"), 3)])
    rows = step()
    assert sorted(r["property_id"] for r in rows) == ["a", "b"]
    assert all(r["firehose_arrival_at"] is not None for r in rows)
    parts = tables.read_archive(spark, archive).first()
    assert (parts["year"], parts["month"], parts["day"], parts["hour"]) == ("2026", "03", "04", "05")


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    first = [packed(record("a"), 1), packed(record("b"), 2), packed(record("a"), 1)]
    write(source, "1.json", first)

    def step():
        stream = ingest.without_repeats(ingest.envelope_stream(spark, str(source)))
        run(
            stream.select("event_id").writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        )
        return sorted(r[0] for r in spark.read.schema("event_id string").parquet(out).collect())

    assert step() == ["shard-0:1", "shard-0:2"]
    write(source, "2.json", [*first, packed(record("c"), 3)])
    assert step() == ["shard-0:1", "shard-0:2", "shard-0:3"]


def test_ingestion_stamps_accepted_records(spark):
    rows = spark.createDataFrame(
        [("a", "KSh 1", "x"), ("b", "", "x")],
        "property_id string, price_raw string, location_raw string",
    )
    accepted, rejected = ingest.accepted_records(rows, stamp())
    assert [r["ingested_at"] for r in accepted.collect()] == ["2026-03-04T05:06:07.000000+00:00"]
    assert rejected.first()["error"] == "Missing required fields: price_raw"


def test_received_requests(spark):
    good = json.dumps(record("a", price_raw="KSh 1"))
    coded = base64.b64encode(json.dumps(record("b", price_raw="KSh 2")).encode()).decode()
    bodies = [
        (good, False), (coded, True), ("%%", True), ("{cut of", False), ("", False), (None, True),
        (json.dumps(record("c")), False), (good, True),
    ]
    requests = spark.createDataFrame(
        [(str(i), body, code, str(i), 1.0) for i, (body, code) in enumerate(bodies)],
        "event_id string, body string, is_base64 boolean, seq string, arrival double",
    )
    sent, rejected = ingest.received(requests, stamp())
    rows = envelope.valid_rows(envelope.decode(sent)).collect()
    assert sorted((r["property_id"], r["_seq"], r["ingested_at"]) for r in rows) == [
        ("a", "0", "2026-03-04T05:06:07.000000+00:00"), ("b", "1", "2026-03-04T05:06:07.000000+00:00"),
    ]
    errors = {r["event_id"]: r["error"] for r in rejected.collect()}
    unread, missing = "Invalid JSON or Base64 encoding", "Missing required fields: "
    assert errors == {
        "2": unread, "3": unread, "4": missing + "location_raw, price_raw, property_id",
        "5": unread, "6": missing + "price_raw", "7": unread,
    }


def test_archive_schema_covers_the_payload():
    assert set(CANONICAL.fieldNames()) < set(tables.archive_schema().fieldNames())
