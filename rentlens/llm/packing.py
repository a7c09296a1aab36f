"""Packing documents into sequences of fixed capacity: minimum bin slack.

A document is its token ids and one closing id. It is cut into full pieces and one rest.
How many pieces there are of each length is all that packing needs to know, and that is
at most one number a length. For the longest length left, a subset-sum over bits picks
the multiset of other lengths that fills a sequence closest to its capacity; the pattern
is used as often as its counts allow. Pieces are numbered within their length, and the
number tells pattern, sequence and place.

Defined results: null text is empty, so it is the closing id alone. A null id is kept.
Repeated rows are packed each for itself. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentlens.llm import tokens
from rentlens.operators.spool import spool

CAPACITY = 2048
CLOSING_ID = 1
#: Pieces that are numbered in one task, about.
NUMBERED = 250_000
PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary"


@dataclass(frozen=True)
class Pattern:
    """`times` sequences, each of these (length, how often) in this order."""

    times: int
    parts: tuple[tuple[int, int], ...]


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of at most counts[length] lengths whose sum is closest below `room`.

    Bit s of `reach` says that some multiset sums to s. Each step adds a length a power
    of two times; going back over the steps tells how often each length was used. Lengths
    are added from the longest, and no more once the room is filled exactly."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room and counts[n] > 0), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left > 0:
            take = min(times, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            times *= 2
        if reach >> room:
            break
    total, used = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    left = {n: c for n, c in counts.items() if c > 0}
    patterns = []
    while left:
        longest = max(left)
        left[longest] -= 1
        used = fill(left, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // k for n, k in used.items())
        patterns.append(Pattern(times, tuple(sorted(used.items(), reverse=True))))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return patterns


def pieces(docs: DataFrame, capacity: int = CAPACITY, closing_id: int = CLOSING_ID, vocabulary: str | None = None) -> DataFrame:
    """The pieces of every row of `docs` (doc_id, text): start and length in tokens, the
    tokens of the document, and the ids as unsigned 32-bit little-endian numbers."""
    path = vocabulary or tokens.vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            ids, row = batch.column("doc_id"), 0
            for texts in tokens.batches(batch.column("text")):
                flat, at = encoder.encode(texts)
                own, start, length, whole, cut = [], [], [], [], []
                for i in range(len(texts)):
                    document = np.append(flat[at[i] : at[i + 1]], np.uint32(closing_id)).astype("<u4")
                    for begin in range(0, len(document), capacity):
                        piece = document[begin : begin + capacity]
                        own.append(row + i)
                        start.append(begin)
                        length.append(len(piece))
                        whole.append(len(document))
                        cut.append(piece.tobytes())
                row += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(own, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, whole)], pa.array(cut, pa.binary())],
                    ["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, PIECE)


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`rows` (with doc_id, start, length) and, for each, sequence_id and offset.

    Rows are written to the shared folder first, so that encoding runs once."""
    rows = spool(rows)
    spark = rows.sparkSession
    lengths = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not lengths:
        return rows.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    # The plan is bounded by the capacity, not by the rows.
    uses: dict[int, list[tuple[int, int, int, int, int]]] = {n: [] for n in lengths}
    numbered = dict.fromkeys(lengths, 0)
    sequences = 0
    for pattern in plan(lengths, capacity):
        offset = 0
        for length, k in pattern.parts:
            begin = numbered[length]
            numbered[length] += k * pattern.times
            uses[length].append((begin, numbered[length], k, sequences, offset))
            offset += length * k
        sequences += pattern.times
    schema = "length long, uses array<struct<begin:long,stop:long,k:long,sequence:long,place:long>>"
    planned = spark.createDataFrame([(n, u) for n, u in uses.items()], schema)

    # A length may hold very many rows: each is numbered within a slice of its length.
    slices = max(1, sum(lengths.values()) // NUMBERED)
    content = [c for c in rows.columns if c != "length"]
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64(*content), F.lit(slices)))
    sizes = sliced.groupBy("length", "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("length", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    within = Window.partitionBy("length", "_slice").orderBy(*content)
    number = F.col("_begin") + F.row_number().over(within) - 1
    use = F.filter("uses", lambda u: (u["begin"] <= F.col("_number")) & (F.col("_number") < u["stop"]))[0]
    inside = F.col("_number") - F.col("_use.begin")
    return (
        sliced.join(begins, ["length", "_slice"])
        .withColumn("_number", number)
        .join(F.broadcast(planned), "length")
        .withColumn("_use", use)
        .select(
            *rows.columns,
            (F.col("_use.sequence") + F.expr("(_number - _use.begin) div _use.k")).alias("sequence_id"),
            (F.col("_use.place") + inside % F.col("_use.k") * F.col("length")).cast("long").alias("offset"),
        )
    )
