"""Whole-batch text work on Arrow buffers with numpy: words, hashes, shingles.

All functions look at every byte of every text. A batch is cut between rows into
parts of bounded size, so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 2 << 20

_RNG = np.random.default_rng(20240607)
_BYTE_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
for _upper in range(ord("A"), ord("Z") + 1):
    _BYTE_CODE[_upper] = _BYTE_CODE[_upper + 32]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)

# Space and the controls from tab to carriage return separate words.
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

_POWERS: dict[int, np.ndarray] = {}


def parts(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch, each with at most PART_BYTES of text or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PART_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text begins and ends; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, PART_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size == PART_BYTES + 1:
            _POWERS[int(base)] = have
    return have[:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of codes[start:end] for each span, by differences of one running sum."""
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * _powers(_BASE, len(codes)), out=sums[1:])
    spans = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(codes) + 1)[starts]
    return mix(spans + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text the number of its first word
    (one entry more than texts)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _IS_WORD[data]
    before, here, after = inside[:-2].copy(), inside[1:-1], inside[2:].copy()
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(here & ~before)
    ends = np.flatnonzero(here & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words with A-Z as a-z."""
    return span_hashes(_BYTE_CODE[data], starts, ends)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of k words inside a text, in order; a text of fewer words, but
    not none, has its whole sequence as one. Second: for each text, where its shingles
    begin (one entry more than texts)."""
    n = len(hashes)
    counts = np.diff(first)
    rolled = np.zeros(max(0, n - k + 1), dtype=np.uint64)
    for j in range(k):
        rolled = rolled * _STEP + hashes[j : n - k + 1 + j] if n >= k else rolled
    rolled = mix(rolled)
    whole = np.maximum(counts - k + 1, 0)
    short = (counts > 0) & (counts < k)
    sizes = np.where(short, 1, whole)
    begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.empty(begin[-1], dtype=np.uint64)
    if whole.sum():
        take = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(whole)])[:-1], whole)
        out[np.repeat(~short, sizes)] = rolled[np.arange(len(take)) + take]
    for i in np.flatnonzero(short):
        value = int(counts[i])
        for h in hashes[first[i] : first[i + 1]]:
            value = (value * int(_STEP) + int(h)) % (1 << 64)
        out[begin[i]] = mix(np.array([value ^ (k << 60)], dtype=np.uint64))[0]
    return out, begin
