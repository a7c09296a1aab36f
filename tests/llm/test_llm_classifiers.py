"""Language and quality: defined cases and held-out accuracy on the small tables."""

from __future__ import annotations

import zstandard
from pyspark.sql import functions as F

from rentlens.llm import language, quality, queries

SMALL = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    found = queries.op1_language_id(spark, SMALL)
    assert found.count() == 1000
    truth = queries.table(spark, SMALL, "documents").select("doc_id", "lang")
    right = found.join(truth, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    assert found.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_language_of_defined_cases(documents, nothing, texts):
    model = language.fit(documents)
    assert set(model.dictionaries) == {"en"}
    found = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(documents, model).collect()]
    assert sorted(i for i, _, _ in found if i is not None) == sorted(i for i, _ in texts if i is not None)
    unknown = {i for i, lang, _ in found if lang == "und"}
    assert {1, 2, 3, 15} <= unknown and 0 not in unknown
    assert language.identify(nothing, model).count() == 0
    empty = language.fit(nothing)
    assert {r["lang_pred"] for r in language.identify(documents, empty).collect()} == {"und"}


def test_margins_decide_acceptance():
    model = language.Model({"a": b"alpha beta gamma delta " * 20, "b": b"uno dos tres cuatro cinco " * 20})
    assert model.predict("alpha beta gamma delta alpha beta gamma delta alpha beta")[::2] == ("a", True)
    # Equal sizes: first in the alphabet, and not accepted.
    assert model.predict("q")[::2] == ("a", False)


def test_number_signs_are_no_letters():
    model = language.Model({"a": b"alpha beta gamma"})
    for text in ("½", "² ①", "Ⅷ ⅳ", "3/4 ٣ _ 🙂", "〇"):
        assert model.predict(text) == ("und", 0.0, False)
    for text in ("ª", "é", "世 ½", "一"):
        assert model.predict(text)[0] == "a"


def test_language_against_a_plain_loop(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    model = language.fit(docs)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    for row in docs.collect():
        words = "".join(c if c.isalpha() else " " for c in (row["text"] or "").lower()).split()
        data, best = " ".join(words).encode(), ("und", 0)
        for n, (lang, passage) in enumerate(sorted(model.dictionaries.items()) if data else []):
            held = zstandard.ZstdCompressionDict(passage, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(dict_data=held, level=model.settings.level, write_content_size=False, write_dict_id=False)
            size = sum(len(coder.compress(data[i : i + 2048])) for i in range(0, len(data), 2048))
            best = (lang, size) if n == 0 or size < best[1] else best
        assert got[row["doc_id"]] == best[0]


def test_quality_of_held_out_documents(spark):
    found = queries.op7_quality(spark, SMALL)
    assert found.count() == 1000
    labels = queries.table(spark, SMALL, "labels")
    part = found.join(labels, "doc_id").filter("held_out")
    right = part.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0]
    assert right > 0.9


def test_quality_of_defined_cases(spark, documents, nothing):
    labels = spark.createDataFrame([(0, 1), (0, 0), (5, 1), (10, 0), (11, 0), (6, 1), (None, 1), (7, None), (99, 1)], "doc_id long, quality int")
    model = quality.fit(documents, labels)
    scores = {r["doc_id"]: r["score"] for r in quality.score(documents, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert scores[1] == scores[2]
    assert quality.keep(documents, model, 0.0).collect() == documents.collect()
    assert quality.keep(documents, model, 1.1).count() == 0
    assert quality.score(nothing, model).count() == 0
    none = quality.fit(documents, labels.filter("false"))
    assert {r["score"] for r in quality.score(documents, none).collect()} == {0.5}
    one = quality.fit(documents, labels.filter("quality = 1 AND doc_id <> 0"))
    assert all(r["score"] > 0.9 for r in quality.score(documents, one).collect())


def test_repeated_words_are_an_indicator():
    import pyarrow as pa

    plain, repeated = quality.n_grams(pa.array(["a b c d", "a a b b"]))
    assert plain.max() < 1 << quality.BITS <= repeated.max()
