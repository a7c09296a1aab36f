from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import plain_fuzzy
from plain_fuzzy import Text
from rentlens.operators import fuzzy, resolve
from rentlens.sources.gazetteer import NAMES

KNOWN = [(n, Text(n.lower())) for n in NAMES]
words = st.text(alphabet="abcdruk ng", max_size=14)


def longest_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@given(words, words)
@settings(max_examples=200, deadline=None)
def test_common_length_matches_the_table_method(a, b):
    assert plain_fuzzy.common_length(a, b) == longest_common(a, b)


@given(words, words)
@settings(max_examples=200, deadline=None)
def test_bound_is_never_below_the_score(a, b):
    assert plain_fuzzy.weighted_ratio(Text(a), Text(b)) <= plain_fuzzy.highest_possible(Text(a), Text(b)) + 1e-9


@given(st.one_of(st.sampled_from(NAMES), words))
@settings(max_examples=100, deadline=None)
def test_pruned_search_equals_full_search(text):
    scores = [(plain_fuzzy.weighted_ratio(Text(text.lower()), t), n) for n, t in KNOWN]
    best = max((s for s, _ in scores), default=0.0)
    want = next(n for s, n in scores if s == best) if best >= 80 and text else None
    assert plain_fuzzy.best_match(text, KNOWN, 80.0)[0] == want


def test_hand_worked_scores():
    # whole: 2 * 9 shared of 9 + 13; token subset: 100 * 0.95.
    assert plain_fuzzy.weighted_ratio(Text("westlands cbd"), Text("westlands")) == 95.0
    # lengths differ by over 1.5: contained stretch 100 * 0.9.
    assert plain_fuzzy.weighted_ratio(Text("kilimani area"), Text("kilimani")) == 90.0
    # one letter lost: 2 * 7 / 15.
    assert round(plain_fuzzy.weighted_ratio(Text("syokmau"), Text("syokimau")), 3) == 93.333
    # words swapped: sorted words agree.
    assert plain_fuzzy.weighted_ratio(Text("hill upper"), Text("upper hill")) == 95.0
    assert plain_fuzzy.weighted_ratio(Text(""), Text("ngara")) == 0.0
    assert plain_fuzzy.partial_ratio("abcd", "xxabcdxx") == 100.0


def test_best_match():
    for text, name in [
        ("Westlands CBD", "Westlands"), ("Ngara Rd", "Ngara"), ("KILELESHWA", "Kileleshwa"),
        ("Nyayo", "Nyayo Estate"), ("Muthaiga", "Muthaiga"), ("Thika Road", None), ("", None),
        (None, None),
    ]:
        assert plain_fuzzy.best_match(text, KNOWN, 80.0)[0] == name


def test_case_can_count():
    known = [(n, Text(n)) for n in NAMES]
    assert plain_fuzzy.best_match("NGARA", known, 80.0, match_case=True)[0] is None


def changed(rng, name):
    letters = list(name)
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(letters) + 1)
        if rng.random() < 0.4 and letters:
            letters.pop(min(at, len(letters) - 1))
        else:
            letters.insert(at, rng.choice("abcdeknrs  é"))
    return "".join(letters)


def worded(rng, names):
    name = rng.choice(names)
    return rng.choice(
        [
            changed(rng, name), changed(rng, name) + ", Nairobi", f"Plot {rng.randrange(99)} {changed(rng, name)} Road Estate",
            " ".join(reversed(name.split())) + rng.choice([" Estate", " North", " C", "  44", ""]), name[: rng.randrange(1, len(name) + 1)],
            "".join(rng.choices("abcdruk ng", k=rng.randrange(1, 14))), changed(rng, name) + " " + changed(rng, rng.choice(names)) + " " + "x" * rng.randrange(90),
        ]
    )


def agree(spark, texts, names, match_case=False):
    df = spark.createDataFrame([(t,) for t in texts], "raw_string string").repartition(3)
    places = spark.createDataFrame([*enumerate(names)], "pos long, name string")
    got = {r["raw_string"]: (names[r["pos"]], round(r["score"], 9)) for r in fuzzy.best_matches(df, places, 80.0, match_case).collect()}
    known = [(n, Text(n if match_case else n.lower())) for n in names]
    want = {t: plain_fuzzy.best_match(t, known, 80.0, match_case) for t in texts if t.split()}
    assert got == {t: (n, round(score, 9)) for t, (n, score) in want.items() if n}
    return got


@pytest.mark.parametrize("few", [0, 10**9])
def test_joins_agree_with_the_plain_scorer(spark, monkeypatch, few):
    monkeypatch.setattr(fuzzy, "FEW_EACH", few)
    rng = random.Random(few)
    texts = sorted({worded(rng, NAMES) for _ in range(700)} | {" ", "a", "c c c", "Runda", "THOME", "y" * 70, "Karen" * 20})
    assert len(agree(spark, [t for t in texts if t], NAMES)) > 300


def test_long_and_short_names_and_case(spark):
    names = ["x" * 70, "y" * 80 + " z", "c", "ab", "Ngara", "ngara", "South C", "a b a b"]
    rng = random.Random(8)
    texts = sorted({worded(rng, names) for _ in range(25)} | {"x" * 66 + "abcd", "NGARA", "b", "ab ab"})
    for match_case in (False, True):
        agree(spark, [t for t in texts if t], names, match_case)


def test_a_hundred_thousand_names(spark):
    rng = random.Random(5)
    parts = [a + b for a in "b d g k l m n r s t w ki ru mu ka nya".split() for b in "a e i o u an ar en".split()]
    names = list({"".join(rng.choices(parts, k=rng.randrange(2, 5))).title() + rng.choice(["", " Estate", " North", " Court"]) for _ in range(120_000)})[:100_000]
    texts = sorted({changed(rng, rng.choice(names)) for _ in range(12)})
    df = spark.createDataFrame([(t,) for t in texts], "raw_string string")
    places = spark.createDataFrame([*enumerate(names)], "pos long, name string").repartition(4)
    got = {r["raw_string"]: r["pos"] for r in fuzzy.best_matches(df, places, 80.0).collect()}
    known = [(n, Text(n.lower())) for n in names]
    for text in texts[:3]:
        name, _ = plain_fuzzy.best_match(text, known, 80.0)
        assert (names[got[text]] if text in got else None) == name


def test_no_python_runs_in_the_match(spark):
    texts = spark.createDataFrame([("Ngara Rd",)], "raw_string string")
    plan = resolve.from_gazetteer(texts)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert fuzzy.best_matches(texts.limit(0), spark.createDataFrame([], "pos long, name string"), 80.0).collect() == []


def test_edit_similarity_ties_go_to_the_earlier_name(spark):
    df = spark.createDataFrame([("abce",), ("zzzz",), (None,)], "x string")
    got = df.select(fuzzy.best_by_edits(F.col("x"), ["abcd", "abcf"], 70.0).alias("m")).collect()
    assert got[0]["m"]["name"] == "abcd" and got[0]["m"]["score"] == 75.0
    assert got[1]["m"] is None and got[2]["m"] is None
