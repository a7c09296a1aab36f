"""Whole-batch text work against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rentlens.llm import arrays, tokens

PIECES = ["'s", "'re", "'", "'ll", " ", "  ", "\n", "\t", " '", "a", "Bc", "é", "12", "½", "!?", "世界", "<|endoftext|>", "\r\n", "🙂", "'S"]


def test_words_and_shingles_are_those_of_plain_python():
    texts = ["a b c d e f", None, "", " x ", "A b C d E F g", "zwei wort drei\tvier", "one two three"]
    data, bounds = arrays.utf8(pa.array(texts))
    starts, ends, first = arrays.words(data, bounds)
    raw = data.tobytes()
    for i, text in enumerate(texts):
        want = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        got = [raw[a:b].decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)]
        assert got == want
    hashes, begin = arrays.shingles(arrays.word_hashes(data, starts, ends), first, 5)
    assert np.diff(begin).tolist() == [2, 0, 0, 1, 3, 1, 1]
    # A-Z are a-z; order and number of words matter.
    assert hashes[begin[0] : begin[1]].tolist() == hashes[begin[4] : begin[4] + 2].tolist()
    assert len(set(hashes.tolist())) == len(hashes) - 2


@pytest.mark.parametrize("seed", range(3))
def test_ids_are_those_of_the_public_tokenizer(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(14))) for _ in range(1500)] + ["x" * 5000, " " * 300, ""]
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    encoder = tokens.Encoder(tokens.vocabulary())
    for _ in range(2):
        ids, at = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
    assert int(encoder.lengths[ids].sum()) == sum(len(t.encode()) for t in texts)


def test_parts_keep_every_row():
    batch = pa.record_batch({"text": pa.array(["a" * 10, None, "b" * (3 << 20), "", "c"])})
    got = [t for part in arrays.parts(batch) for t in part.column("text").to_pylist()]
    assert got == batch.column("text").to_pylist()
