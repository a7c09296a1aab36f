"""Token counts of the parts of a document.

A document is the fields of a row, joined by line breaks, and is encoded once as a whole.
Its sections are its lines; a line break belongs to the line that it ends. Token spans
are joined to section spans by position. A token that crosses a boundary counts, by rule
`first`, for the section that holds its first byte, or, by rule `share`, for each section
by the share of its bytes there. Both rules give every token away exactly once.

Defined results: a null field is empty and has one section without tokens; so has an
empty text. Repeated rows give repeated results; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm import tokens

RESULT = "doc_id long, field string, section int, start long, end long, n_tokens double, n_crossing long"


def sections(parts: Sequence[str]) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """For each section its field and number, and the ends of all sections in bytes and in
    code points of the joined text."""
    owner, in_bytes, in_points = [], [], []
    for place, part in enumerate(parts):
        lines = part.split("\n")
        for number, line in enumerate(lines):
            closed = number < len(lines) - 1 or place < len(parts) - 1
            owner.append((place, number))
            in_bytes.append(len(line.encode()) + closed)
            in_points.append(len(line) + closed)
    return owner, np.cumsum(in_bytes), np.cumsum(in_points)


def counted(lengths: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and how many of those it touches cross a boundary.
    `lengths`: bytes of the tokens in order; `ends`: where sections end."""
    stops = np.cumsum(lengths)
    starts = stops - lengths
    first = np.searchsorted(ends, starts, "right")
    last = np.searchsorted(ends, stops, "left")
    crossing = np.flatnonzero(last > first)
    n = np.bincount(first, minlength=len(ends)).astype(float)
    touched = np.zeros(len(ends), dtype=np.int64)
    for token in crossing:
        inside = np.arange(first[token], last[token] + 1)
        inside = inside[np.diff(np.concatenate([[0], ends]))[inside] > 0]
        touched[inside] += 1
        if rule == "share":
            edges = np.clip(np.concatenate([[0], ends]), starts[token], stops[token])
            n[first[token]] -= 1
            n[inside] += np.diff(edges)[inside] / lengths[token]
    return n, touched


def attribute(
    docs: DataFrame, fields: Sequence[str] = ("text",), rule: str = "first", vocabulary: str | None = None
) -> DataFrame:
    """One row for each section: its span in code points of the joined text, and tokens."""
    if rule not in ("first", "share"):
        raise ValueError(f"no rule {rule}")
    path = vocabulary or tokens.vocabulary()
    names = list(fields)
    out = pa.schema([
        ("doc_id", pa.int64()), ("field", pa.string()), ("section", pa.int32()), ("start", pa.int64()),
        ("end", pa.int64()), ("n_tokens", pa.float64()), ("n_crossing", pa.int64()),
    ])

    def part_rows(encoder, ids: list, rows: list[tuple[str, ...]]) -> pa.RecordBatch:
        flat, at = encoder.encode(["\n".join(r) for r in rows])
        lengths = encoder.lengths[flat]
        columns: list[list] = [[] for _ in out]
        for i, row in enumerate(rows):
            owner, ends, points = sections(row)
            n, crossing = counted(lengths[at[i] : at[i + 1]], ends, rule)
            columns[0] += [ids[i]] * len(owner)
            columns[1] += [names[place] for place, _ in owner]
            columns[2] += [number for _, number in owner]
            columns[3] += np.concatenate([[0], points[:-1]]).tolist()
            columns[4] += points.tolist()
            columns[5] += n.tolist()
            columns[6] += crossing.tolist()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            rows = list(zip(*[[t or "" for t in batch.column(k + 1).to_pylist()] for k in range(len(names))], strict=True))
            ids = batch.column(0).to_pylist()
            begin, size = 0, 0
            for i, row in enumerate(rows):
                more = sum(map(len, row))
                if i > begin and size + more > tokens.PART_CHARS:
                    yield part_rows(encoder, ids[begin:i], rows[begin:i])
                    begin, size = i, 0
                size += more
            if rows:
                yield part_rows(encoder, ids[begin:], rows[begin:])

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("_id"), *[F.col(f).cast("string").alias(f"_{k}") for k, f in enumerate(names)]
    )
    return chosen.mapInArrow(run, RESULT)
