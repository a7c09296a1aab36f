"""Packing, training order, token counts and the pipeline."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rentlens.llm import attribution, packing, pii, quality, queries, tokens, training_order
from test_llm_similar import contamination, grouped, shingle_set

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encode():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: plain.encode(text or "", add_special_tokens=False).ids


def whole(pieces, documents):
    """Pieces put together are the documents, and sequences are gapless and full."""
    by_sequence: dict[int, list] = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spans in by_sequence.values():
        reach = 0
        for offset, length in sorted(spans):
            assert offset == reach
            reach += length
        assert reach <= packing.CAPACITY
    return by_sequence


def test_packed_pieces_are_the_documents(spark, encode):
    rows = queries.op8_packing(spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SMALL, "documents").collect()}
    for doc, text in texts.items():
        ids = np.array([*encode(text), packing.CLOSING_ID], dtype="<u4")
        reach = 0
        for p in sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"]):
            assert p["start"] == reach and p["doc_tokens"] == len(ids)
            reach += p["length"]
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : reach].tobytes())
        assert reach == len(ids)
    filled = whole(rows, texts)
    tokens = sum(r["length"] for r in rows)
    assert len(filled) <= tokens // packing.CAPACITY + 3


def test_packing_of_defined_cases(documents, nothing, texts):
    rows = packing.pack(packing.pieces(documents), packing.CAPACITY).collect()
    assert sorted(str(r["doc_id"]) for r in rows if r["start"] == 0) == sorted(str(i) for i, _ in texts)
    assert {r["doc_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    whole(rows, texts)
    assert packing.pack(packing.pieces(nothing)).count() == 0


def test_fill_is_the_best_subset_sum():
    rng = np.random.default_rng(6)
    for _ in range(300):
        counts = {int(n): int(rng.integers(1, 5)) for n in rng.integers(1, 40, rng.integers(0, 6))}
        room = int(rng.integers(0, 80))
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        used = packing.fill(counts, room)
        assert all(k <= counts[n] for n, k in used.items())
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= room)


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(7)
    counts = {int(n): int(rng.integers(1, 900)) for n in np.append(rng.integers(1, 2049, 150), rng.integers(1, 300, 150))}
    used: dict[int, int] = {}
    sequences = 0
    for pattern in packing.plan(counts):
        assert sum(n * k for n, k in pattern.parts) <= packing.CAPACITY
        sequences += pattern.times
        for n, k in pattern.parts:
            used[n] = used.get(n, 0) + k * pattern.times
    assert used == counts
    assert sequences <= 1.02 * sum(n * c for n, c in counts.items()) / packing.CAPACITY + 3


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000])
def test_permutation_is_one_and_comes_back(n):
    slots = training_order.permuted(np.arange(n), n, key=9)
    assert sorted(slots.tolist()) == list(range(n))
    assert training_order.sequence_at(slots, n, key=9).tolist() == list(range(n))
    assert n < 17 or training_order.permuted(np.arange(n), n, key=10).tolist() != slots.tolist()


def test_shards_read_back_as_the_documents(spark, documents, texts, encode, tmp_path):
    table = str(tmp_path / "docs")
    documents.write.parquet(table)
    folder = str(tmp_path / "shards")
    n = training_order.write(spark.read.parquet(table), folder, length=64, shard=32)
    rows = training_order.read(spark, folder, length=64, shard=32).orderBy("sequence").collect()
    assert sorted(r["slot"] for r in rows) == list(range(n)) == [r["sequence"] for r in rows]
    assert all(r["sound"] for r in rows)
    want = training_order.permuted(np.arange(n), n)
    assert [r["slot"] for r in rows] == want.tolist()
    assert sum(r["n_tokens"] for r in rows) == sum(len(encode(t)) + 1 for _, t in texts)
    stride = training_order.HEADER.itemsize + 64 * 2 + 1
    got = []
    for r in rows:
        (path,) = (tmp_path / "shards" / f"shard={r['shard']}").glob("part-*")
        content = path.read_bytes()[r["byte_offset"] : r["byte_offset"] + stride]
        got += np.frombuffer(content[training_order.HEADER.itemsize : -1], "<u2")[: r["n_tokens"]].tolist()
    docs = [i for chunk in _split(got, training_order.CLOSING_ID) for i in [tuple(chunk)]]
    assert sorted(docs) == sorted(tuple(encode(t)) for _, t in texts)


def _split(ids, mark):
    out = []
    for i in ids:
        if i == mark:
            yield out
            out = []
        else:
            out.append(i)


def test_training_order_of_the_small_table(spark, nothing):
    rows = queries.op9_training_order(spark, SMALL).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows))) and all(r["sound"] for r in rows)
    assert training_order.materialise(nothing).count() == 0


@pytest.mark.parametrize("rule", ["first", "share"])
def test_sections_share_all_tokens(documents, nothing, texts, encode, rule):
    rows = attribution.attribute(documents, rule=rule).collect()
    for doc in (0, 1, 2, 7, 13, 14):
        text = dict(texts)[doc] or ""
        mine = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["section"])
        assert len(mine) == text.count("\n") + 1
        assert sum(r["n_tokens"] for r in mine) == pytest.approx(len(encode(text)))
        assert [r["start"] for r in mine] == [0, *[r["end"] for r in mine][:-1]] and mine[-1]["end"] == len(text)
    assert attribution.attribute(nothing).count() == 0


def test_boundaries_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lengths = rng.integers(1, 6, rng.integers(1, 20))
        cuts = np.sort(rng.integers(0, lengths.sum() + 1, rng.integers(0, 6)))
        ends = np.append(cuts, lengths.sum())
        owner = np.searchsorted(ends, np.arange(lengths.sum()), "right")
        spans = np.split(owner, np.cumsum(lengths)[:-1])
        first, crossing = attribution.counted(lengths, ends, "first")
        share, _ = attribution.counted(lengths, ends, "share")
        assert first.tolist() == [sum(s[0] == i for s in spans) for i in range(len(ends))]
        assert share == pytest.approx([sum((s == i).mean() for s in spans) for i in range(len(ends))])
        assert crossing.tolist() == [sum(i in s and len(set(s)) > 1 for s in spans) for i in range(len(ends))]


def test_fields_are_one_document(spark, encode):
    df = spark.createDataFrame([(1, "Title", "body text\nmore"), (2, None, "x")], "doc_id long, title string, text string")
    rows = attribution.attribute(df, ["title", "text"]).collect()
    assert [(r["doc_id"], r["field"], r["section"]) for r in rows] == [(1, "title", 0), (1, "text", 0), (1, "text", 1), (2, "title", 0), (2, "text", 0)]
    assert sum(r["n_tokens"] for r in rows if r["doc_id"] == 1) == len(encode("Title\nbody text\nmore"))


def test_pipeline_stages_take_effect(spark):
    docs = queries.table(spark, SMALL, "documents")
    before = {r["doc_id"] for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    accepted = stage["quality"](spark, docs, SMALL)
    assert accepted.columns == docs.columns and accepted.count() < len(before)
    labels = queries.table(spark, SMALL, "labels").filter("quality = 1").join(docs, "doc_id")
    assert accepted.join(labels.select("doc_id"), "doc_id").count() > 0.97 * labels.count()


def test_pipeline_against_brute_force(spark, encode):
    docs, labels = queries.table(spark, SMALL, "documents"), queries.table(spark, SMALL, "labels")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = quality.fit(docs, labels)
    scores = model.scores(quality.n_grams(pa.array(texts.values())))
    texts = {i: t for (i, t), s in zip(texts.items(), scores, strict=True) if s >= 0.3}
    roots = grouped({i: shingle_set(t) for i, t in texts.items()})
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SMALL, "benchmark").collect()]
    clean = {i: t for i, t in texts.items() if roots[i] == i and not contamination(t, items)[1]}
    want = {}
    for i, text in clean.items():
        ids = np.array([*encode(pii.redacted(text)), packing.CLOSING_ID], dtype="<u4")
        for start in range(0, len(ids), packing.CAPACITY):
            piece = ids[start : start + packing.CAPACITY]
            want[i, start] = (len(piece), len(ids), zlib.crc32(piece.tobytes()))
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {(r["doc_id"], r["start"]): (r["length"], r["doc_tokens"], r["ids_crc32"]) for r in rows} == want
    whole(rows, None)
    assert len(clean) < len(texts) < docs.count()


def test_ids_are_those_of_the_library_with_its_added_tokens(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = [
        f"a {mark} b", mark, mark * 3, f"{mark}\n\n x", f"it's  {mark}'s  ", f"\t {mark} \n{mark}", "<|endoftext|", mark[:6], mark[6:],
        f"<|{mark}|>", f"世界{mark}É 12{mark}34", mark.upper(), "", " plain text",
    ]
    vocabulary = tokens.Encoder(tokens.vocabulary())
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        flat, at = vocabulary.encode(texts)
        assert [flat[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == want
        assert vocabulary.lengths[flat].sum() == sum(len(t.encode()) for t in texts)
    rows = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in rows} == {i: [*ids, packing.CLOSING_ID] for i, ids in enumerate(want)}
