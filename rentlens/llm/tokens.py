"""Token ids of whole texts with a public byte-level BPE vocabulary.

The vocabulary's split pattern is applied to all texts of a part at once, on arrays of
code points. Pieces repeat, so only pieces that a worker has not met are encoded by the
vocabulary's own library; the ids of the others are looked up by a 64-bit hash.

Added tokens that the vocabulary's tokenizers file names are found first, as its library
does: each is one id, and the texts between them are split as texts of their own.
"""

from __future__ import annotations

import base64
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

from rentlens.llm.arrays import mix, span_hashes

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pieces a worker remembers before it starts anew, and characters it encodes at once, or
#: one text: what bounds its memory.
REMEMBERED = 1 << 19
PART_CHARS = 1 << 19

_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
_KIND = {"L": _LETTER, "N": _NUMBER}
#: What may follow an apostrophe in a piece of its own.
_ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
#: White space of the Unicode standard.
_WHITE = [*range(9, 14), 32, 133, 160, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def _kinds() -> np.ndarray:
    """The class of every code point of the Unicode standard."""
    kinds = np.full(0x110000, _OTHER, dtype=np.uint8)
    for point in range(0x110000):
        kind = _KIND.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            kinds[point] = kind
    kinds[_WHITE] = _SPACE
    return kinds


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text begins and ends."""
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), bounds


def pieces(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of the split pattern begin, in all texts. A piece is a run of
    letters, numbers or other marks with at most one space before it, an apostrophe with
    its ending, or white space up to the last before a word."""
    n = len(points)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kind = _kinds()[points]
    text_start = np.zeros(n + 1, dtype=bool)
    text_start[bounds] = True
    starts = text_start[:n].copy()
    starts[1:] |= kind[1:] != kind[:-1]
    # The last white space of a run that a word of the same text follows.
    white = kind == _SPACE
    last = np.zeros(n, dtype=bool)
    last[:-1] = white[:-1] & ~white[1:] & ~text_start[1:n]
    joins = last & (points == 32)
    starts |= last
    starts[1:][joins[:-1]] = False
    marks = np.flatnonzero(starts & (points == ord("'")))
    marks = marks[marks + 1 < n]
    marks = marks[(kind[marks + 1] == _LETTER) & ~text_start[marks + 1]]
    for mark in marks:
        for ending in _ENDINGS:
            stop = mark + 1 + len(ending)
            if stop <= n and not text_start[mark + 1 : stop].any() and np.array_equal(points[mark + 1 : stop], [ord(c) for c in ending]):
                starts[mark + 1] = False
                if stop < n:
                    starts[stop] = True
                break
    return np.flatnonzero(starts)


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the added tokens in the tokenizers file beside a rank file, if there is one."""
    beside = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(beside):
        return {}
    with open(beside, encoding="utf-8") as file:
        listed = json.load(file).get("added_tokens") or []
    for token in listed:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} matches by more than its text")
    return {token["content"]: token["id"] for token in listed}


class Encoder:
    """Encodes texts; one lives in each worker."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = added_tokens(path)
        # The leftmost, and of those the longest.
        self.find_added = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))).finditer if self.added else None
        ranks |= {token.encode(): number for token, number in self.added.items()}
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, number in ranks.items():
            self.lengths[number] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins and ends."""
        points, bounds = code_points(texts)
        added = self._added_spans(texts, bounds)
        starts = pieces(points, np.union1d(bounds, added))
        if len(added):
            # An added token is one piece.
            span = np.searchsorted(added[:, 0], starts, "right") - 1
            starts = starts[(span < 0) | (starts == added[span, 0]) | (starts >= added[span, 1])]
        if not len(starts):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)
        ends = np.append(starts[1:], len(points))
        hashes = span_hashes(mix(points.astype(np.uint64) + np.uint64(1)), starts, ends)
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        entry = self._entries(distinct, example, starts, ends, points)[which]
        sizes = self.sizes[entry]
        stops = np.cumsum(sizes)
        shift = np.repeat(self.begin[entry] - (stops - sizes), sizes)
        ids = self.ids[np.arange(stops[-1]) + shift]
        at = np.concatenate([[0], stops])
        return ids, at[np.searchsorted(starts, bounds)]

    def _added_spans(self, texts: list[str], bounds: np.ndarray) -> np.ndarray:
        """Begin and end of every added token, in all texts."""
        if self.find_added is None:
            return np.zeros((0, 2), dtype=np.int64)
        spans = [(begin + m.start(), begin + m.end()) for text, begin in zip(texts, bounds.tolist(), strict=False) for m in self.find_added(text)]
        return np.array(spans, dtype=np.int64).reshape(-1, 2)

    def _entries(self, distinct, example, starts, ends, points) -> np.ndarray:
        """The remembered entry of each distinct piece; new ones are encoded first."""
        if len(self.hashes) > REMEMBERED:
            self._forget()
        slot = np.searchsorted(self.hashes, distinct)
        known = slot < len(self.hashes)
        known[known] = self.hashes[slot[known]] == distinct[known]
        if not known.all():
            where = example[~known]
            encode = self.plain.encode_ordinary
            new = [
                [self.added[piece]] if piece in self.added else encode(piece)
                for piece in (points[a:b].tobytes().decode("utf-32-le") for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True))
            ]
            sizes = np.array([len(x) for x in new], dtype=np.int64)
            begin = len(self.ids) + np.cumsum(sizes) - sizes
            self.ids = np.concatenate([self.ids, np.array([i for x in new for i in x], dtype=np.uint32)])
            self.hashes = np.insert(self.hashes, slot[~known], distinct[~known])
            self.begin = np.insert(self.begin, slot[~known], begin)
            self.sizes = np.insert(self.sizes, slot[~known], sizes)
            slot = np.searchsorted(self.hashes, distinct)
        return slot


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def batches(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a column in lists of bounded size; null is empty."""
    held, size = [], 0
    for text in column.to_pylist():
        text = text or ""
        if held and size + len(text) > PART_CHARS:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held
