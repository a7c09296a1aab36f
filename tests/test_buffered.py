from __future__ import annotations

import base64
import json
import time

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from rentlens.config import Settings
from rentlens.schema import LANDED
from rentlens.sources import tables
from rentlens.streaming import buffered, ingest

LATER = Settings(buffer_bytes=1 << 30, buffer_seconds=600)


def add(folder, name, numbers, spoilt=False):
    folder.mkdir(exist_ok=True)
    lines = []
    for i in numbers:
        body = json.dumps(dict(property_id=f"p{i}", price_ksh=i, location_raw="Ngära\n\"x\""))
        data = "%%" if spoilt else base64.b64encode(body.encode()).decode()
        lines.append(json.dumps(dict(event_id=f"shard-0:{i}", data=data, seq=str(i), arrival=1.7e9 + i)))
    (folder / name).write_text("\n".join(lines))


class Job:
    """A stream over one folder, started anew for each delivery."""

    def __init__(self, spark, tmp):
        self.spark, self.inbox, self.path, self.marks = spark, tmp / "in", str(tmp / "archive"), str(tmp / "marks")
        self.files = 0

    def run(self, numbers=None, s=LATER, hour=5, clock=time.time, spoilt=False):
        if numbers is not None:
            add(self.inbox, f"{self.files}.json", numbers, spoilt)
            self.files += 1
        stamp = F.lit(f"2026-03-04 {hour:02d}:06:07").cast("timestamp_ntz")
        stream = ingest.envelope_stream(self.spark, str(self.inbox), files_per_batch=1)
        query = buffered.start_buffered(stream, self.path, self.marks, stamp=stamp, s=s, clock=clock)
        query.awaitTermination()

    def numbers(self):
        return sorted(r["price_ksh"] for r in tables.read_archive(self.spark, self.path).collect())

    def held(self):
        return [h.batch_id for h in buffered.waiting(self.spark, self.path)]

    def stored(self, tmp):
        return sorted(f for f in (tmp / "archive").rglob("part-*"))


@pytest.fixture
def job(spark, tmp_path):
    return Job(spark, tmp_path)


def test_a_trickle_leaves_few_large_files(job, tmp_path):
    for i in range(6):
        job.run(range(10 * i, 10 * i + 10))
    assert job.held() == list(range(6)) and not (tmp_path / "archive").exists()
    size = sum(h.size for h in buffered.waiting(job.spark, job.path))
    job.run(range(60, 70), s=Settings(buffer_bytes=size + 1))
    assert job.held() == [] and job.numbers() == list(range(70))
    [file] = job.stored(tmp_path)
    assert file.stat().st_size > size
    # Hours stay apart, and each is one file.
    job.run(range(70, 80), hour=6)
    job.run(range(80, 90), hour=7)
    job.run(range(90, 95), hour=7)
    buffered.drain(job.spark, job.path)
    assert len(job.stored(tmp_path)) == 3 and job.numbers() == list(range(95))
    rows = tables.read_archive(job.spark, job.path)
    assert rows.filter("hour = '07'").count() == 15 and rows.filter("hour = '05'").count() == 70
    assert {r["location_raw"] for r in rows.collect()} == {'Ngära\n"x"'}


def test_the_oldest_decides_by_age(job):
    begin = time.time()
    job.run(range(3))
    job.run(range(3, 5), clock=lambda: begin + 590)
    assert job.held() == [0, 1]
    # Without a new delivery: the start of the job writes what has waited.
    job.run(clock=lambda: begin + 660)
    assert job.held() == [] and job.numbers() == list(range(5))
    assert buffered.flush_due(job.spark, job.path) == [] and buffered.drain(job.spark, job.path) == []


def test_a_large_batch_is_not_written_anew(job, monkeypatch):
    monkeypatch.setattr(buffered, "_together", lambda *a: pytest.fail("written anew"))
    job.run(range(50), s=Settings(buffer_bytes=100))
    assert job.held() == [] and job.numbers() == list(range(50))


@pytest.mark.parametrize("broken", ["_together", "_release", "move"])
def test_failures_between_the_steps_neither_lose_nor_repeat(job, monkeypatch, broken):
    job.run(range(4))
    job.run(range(4, 8))
    size = sum(h.size for h in buffered.waiting(job.spark, job.path))
    real, calls = getattr(buffered, broken), []

    def fails(spark, *rest):
        # Not the first move, which holds the batch, and not a release of nothing.
        calls.append(rest)
        if (broken == "move" and len(calls) == 1) or (broken == "_release" and not rest[-1]):
            return real(spark, *rest)
        if broken == "_release":
            real(spark, rest[0], rest[-1][:1])
        raise RuntimeError("lost")

    monkeypatch.setattr(buffered, broken, fails)
    with pytest.raises(StreamingQueryException):
        job.run(range(8, 12), s=Settings(buffer_bytes=size + 1))
    monkeypatch.setattr(buffered, broken, real)
    job.run(range(12, 14))
    buffered.drain(job.spark, job.path)
    assert job.held() == [] and job.numbers() == list(range(14))


def test_nothing_valid_holds_no_file(job):
    job.run(range(5), spoilt=True)
    assert [h.files for h in buffered.waiting(job.spark, job.path)] == [0]
    assert buffered.drain(job.spark, job.path) == [] and job.held() == []
    job.run(range(5, 7))
    buffered.drain(job.spark, job.path)
    assert job.numbers() == [5, 6]


def test_two_checkpoints_and_a_landing_stream(job, tmp_path):
    job.run(range(3))
    job.marks += "-new"
    job.run()
    buffered.drain(job.spark, job.path)
    # A new checkpoint reads all files again: deliveries may repeat, and none is lost.
    assert job.numbers() == [0, 0, 1, 1, 2, 2]
    landed = str(tmp_path / "landed")
    for numbers in (range(3, 6), None):
        job.run(numbers)
        buffered.drain(job.spark, job.path)
        ingest.start_landing(job.spark, job.path, landed, str(tmp_path / "l")).awaitTermination()
    got = job.spark.read.schema(LANDED).parquet(landed).groupBy("price_ksh").count().collect()
    assert dict(got) == {0: 2, 1: 2, 2: 2, 3: 1, 4: 1, 5: 1}
