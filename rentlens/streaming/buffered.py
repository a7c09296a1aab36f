"""Deliveries held back until they make large files.

A trickle of small batches would leave as many small files in the archive, which every
later scan has to open. Here a batch is first held as files of its own. When what is held
reaches a size, or the oldest of it has waited long enough, all of it is written as few
large files, by hour like the archive, and put in place by one rename. Readers of the
archive, streams among them, only ever see whole files.

Nothing waits in memory or in streaming state, so a lost driver or executor loses nothing.
A batch that is read again replaces what it had held, and is left out if it has been
written: files are named by the query and the last batch in them. A lone batch whose files
are large already is renamed instead of written anew.

Age is looked at when a job starts and after each of its batches. A stream that never ends
and gets no deliveries has no batches; end it, or run `flush_due` after it has ended. The
store must rename folders as a whole.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rentlens.config import DEFAULTS, Settings
from rentlens.functions.dates import archive_partitions, now_utc
from rentlens.schema import CANONICAL
from rentlens.sources import envelope
from rentlens.sources.tables import ARCHIVE_PARTITIONS
from rentlens.streaming.ingest import delete, located, move, start_batches

HELD = "value string, batch_id long, " + ", ".join(f"{p} string" for p in ARCHIVE_PARTITIONS)


@dataclass(frozen=True)
class Held:
    """A batch that waits: its size, its files, and when it was stored."""

    query: str
    batch_id: int
    size: int
    files: int
    since: float


def start_buffered(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    payload: T.StructType = CANONICAL,
    stamp: Column | None = None,
    s: Settings = DEFAULTS,
    clock: Callable[[], float] = time.time,
) -> StreamingQuery:
    """Valid records as NDJSON by hour of processing time, like `ingest.start_archive`, in
    files of some size. Writes what is due before it reads anything new."""
    spark = envelopes.sparkSession
    when = stamp if stamp is not None else now_utc()
    flush_due(spark, path, s, clock)

    def store(batch: DataFrame, batch_id: int, query: str) -> None:
        # The session of the batch has its settings; folders are the same in both.
        if _exists(spark, _written(path, query, batch_id)):
            _settle(spark, path)
            return
        rows = envelope.valid_rows(envelope.decode(batch, payload))
        attempt = _attempt(path)
        rows.withColumns(archive_partitions(when)).write.partitionBy(*ARCHIVE_PARTITIONS).json(attempt)
        move(spark, attempt, _held(path, query, batch_id))
        flush_due(spark, path, s, clock)

    return start_batches(envelopes, checkpoint, store)


def waiting(spark: SparkSession, path: str) -> list[Held]:
    """What is held for `path`, by query and batch."""
    fs, root = located(spark, f"{path}-held")
    if not fs.exists(root):
        return []
    out = []
    for query in fs.listStatus(root):
        for batch in fs.listStatus(query.getPath()):
            parts = fs.listStatus(batch.getPath())
            hours = [p.getPath() for p in parts if p.isDirectory()]
            inside = [fs.getContentSummary(p) for p in hours]
            out.append(
                Held(
                    query.getPath().getName().removeprefix("query="),
                    int(batch.getPath().getName().removeprefix("batch_id=")),
                    sum(i.getLength() for i in inside),
                    sum(i.getFileCount() for i in inside),
                    max((p.getModificationTime() for p in parts), default=batch.getModificationTime()) / 1000,
                )
            )
    return sorted(out, key=lambda h: (h.query, h.batch_id))


def flush_due(
    spark: SparkSession, path: str, s: Settings = DEFAULTS, clock: Callable[[], float] = time.time
) -> list[str]:
    """Write what has reached the size or the age; the folders that were written. Not to
    be run beside the stream itself."""
    now = clock()
    return _flush(
        spark, path, s,
        lambda held: sum(h.size for h in held) >= s.buffer_bytes
        or now - min(h.since for h in held) >= s.buffer_seconds,
    )


def drain(spark: SparkSession, path: str, s: Settings = DEFAULTS) -> list[str]:
    """Write all that is held, whatever its size and age."""
    return _flush(spark, path, s, lambda held: True)


def _flush(spark: SparkSession, path: str, s: Settings, due: Callable[[list[Held]], bool]) -> list[str]:
    by_query: dict[str, list[Held]] = {}
    for h in _settle(spark, path):
        by_query.setdefault(h.query, []).append(h)
    out = []
    for query, held in by_query.items():
        if not due(held):
            continue
        # A batch without valid records holds no files.
        full = [h for h in held if h.files]
        if full:
            target = _written(path, query, held[-1].batch_id)
            if len(full) == 1 and full[0].size >= full[0].files * s.buffer_bytes / 2:
                move(spark, _held(path, query, full[0].batch_id), target)
            else:
                move(spark, _together(spark, path, query, full), target)
            out.append(target)
        _release(spark, path, held)
    return out


def _together(spark: SparkSession, path: str, query: str, held: list[Held]) -> str:
    """The lines of all held batches in a folder of their own, as they are. Adaptive
    execution cuts the rows of an hour at its advised size."""
    lines = (
        spark.read.schema(HELD)
        .option("basePath", f"{path}-held/query={query}")
        .text([_held(path, query, h.batch_id) for h in held])
        .drop("batch_id")
    )
    attempt = _attempt(path)
    lines.hint("rebalance", *ARCHIVE_PARTITIONS).write.partitionBy(*ARCHIVE_PARTITIONS).text(attempt)
    return attempt


def _settle(spark: SparkSession, path: str) -> list[Held]:
    """What waits, after what an interrupted job has written but not released is released."""
    held = waiting(spark, path)
    last = {
        h.query: h.batch_id for h in held if _exists(spark, _written(path, h.query, h.batch_id))
    }
    done = [h for h in held if h.batch_id <= last.get(h.query, -1)]
    _release(spark, path, done)
    return [h for h in held if h not in done]


def _release(spark: SparkSession, path: str, held: list[Held]) -> None:
    # The last one tells that all before it are written, so it goes last.
    for h in held:
        delete(spark, _held(path, h.query, h.batch_id))


def _exists(spark: SparkSession, path: str) -> bool:
    fs, place = located(spark, path)
    return fs.exists(place)


def _attempt(path: str) -> str:
    return f"{path}-attempts/{uuid.uuid4().hex}"


def _held(path: str, query: str, batch_id: int) -> str:
    return f"{path}-held/query={query}/batch_id={batch_id}"


def _written(path: str, query: str, batch_id: int) -> str:
    return f"{path}/written={query}-{batch_id}"
