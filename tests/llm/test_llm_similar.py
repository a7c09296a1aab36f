"""Near duplicates, passages, decontamination and neighbours against brute force."""

from __future__ import annotations

import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from check import rows_of
from rentlens.llm import bitmaps, components, decontaminate, near_duplicates, nearest, passages, queries

SMALL = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text: str | None) -> set:
    w = re.findall(WORD, lower(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def grouped(sets: dict[int, set]) -> dict[int, int]:
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_groups_of_defined_cases(documents, nothing, texts):
    got = near_duplicates.groups(documents).collect()
    assert len(got) == len(texts)
    sets = {i: shingle_set(t) for i, t in texts if i is not None}
    want = grouped(sets)
    for row in got:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            i = row["doc_id"]
            assert (row["n_shingles"], row["component_id"], row["kept"]) == (len(sets[i]), want[i], want[i] == i)
    assert near_duplicates.groups(nothing).count() == 0
    kept = near_duplicates.keep(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(i for i in want if want[i] == i)


@pytest.mark.parametrize("swap", [False, True])
def test_one_id_on_rows_of_different_texts_is_one_document(spark, swap):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in ("ba" if swap else "ab") + "c")
    rows = [(5, a), (7, a), (3, b), (5, b), (5, None), (5, a), (5, ""), (9, None), (9, c), (11, c), (12, ""), (12, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_duplicates.groups(docs).collect()
    assert len(got) == len(rows)
    of = {}
    for r in got:
        of.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"], r["kept"]))
    assert all(len(v) == 1 for v in of.values())
    assert of[9] == {(56, 9, True)} and of[11] == {(56, 9, False)} and of[12] == {(0, 12, True)}
    # Id 5 stands for one of its texts, and is linked with the others of that text.
    with_a = {3: {(56, 3, True)}, 5: {(56, 5, True)}, 7: {(56, 5, False)}}
    with_b = {3: {(56, 3, True)}, 5: {(56, 3, False)}, 7: {(56, 7, True)}}
    assert {i: of[i] for i in (3, 5, 7)} in (with_a, with_b)
    kept = sorted((r["doc_id"], r["text"] or "") for r in near_duplicates.keep(docs).collect())
    stays = [(3, b), (5, a)] if of[5] == with_a[5] else [(3, b), (7, a)]
    assert kept == [*stays, (9, c), (12, "")]


def test_large_group_of_near_copies_keeps_its_links(spark):
    """Copies each with its own changes; some are linked through others only."""
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(400):
        text = list(base)
        for at in rng.choice(150, rng.integers(0, 7), replace=False):
            text[at] = f"x{i}_{at}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(f"y{i}_{j}" for j in range(100))) for i in range(50)]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == grouped({i: shingle_set(t) for i, t in rows})


def test_texts_that_need_no_join_are_not_shuffled(spark):
    rows = [(i, " ".join(f"y{i}_{j}" for j in range(30))) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)] + [(None, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in range(0, 1020, 51)], "doc_id long")
    held = {r["doc_id"] for r in docs.filter(bitmaps.may_hold(ids)).select("doc_id").collect()}
    wanted = {r["doc_id"] for r in ids.collect()} & {i for i, _ in rows}
    assert wanted <= held and None not in held and len(held) <= len(wanted) + 3
    kept = near_duplicates.keep(docs)
    assert sorted(kept.collect(), key=str) == sorted(rows[:300] + rows[-1:], key=str)
    union = kept._jdf.queryExecution().optimizedPlan()
    most_rows = union.children().apply(0).toString()
    assert union.nodeName() == "Union" and "Join" not in most_rows and "Aggregate" not in most_rows


def test_small_table_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SMALL, "documents").collect()}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    want = {i: (len(sets[i]), root, root == i) for i, root in grouped(sets).items()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in queries.op4_near_duplicates(spark, SMALL).collect()}
    assert got == want


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    for size in (1, 3, 40, 1000):
        agreed, true = [], []
        for _ in range(40):
            both, a, b = rng.integers(1, 1 << 63, (3, size), dtype=np.uint64)
            x, y = np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))
            agreed.append((near_duplicates.sketch(x) == near_duplicates.sketch(y)).mean())
            true.append(1 / 3)
        assert abs(np.mean(agreed) - np.mean(true)) < 0.06
    one = np.array([5], dtype=np.uint64)
    assert (near_duplicates.sketch(one) == near_duplicates.sketch(one)).all()


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_passages_of_defined_cases(documents, nothing):
    found = passages.repeated(documents).collect()
    shared = {(r["doc_id"], r["other_id"]): r for r in found}
    assert {(11, 10), (12, 10), (4, 0), (5, 0)} <= set(shared)
    for r in found:
        assert r["n_words"] >= 50 and r["similarity"] >= 0.75 and r["other_id"] < r["doc_id"]
    assert (shared[11, 10]["start_word"], shared[11, 10]["other_start_word"], shared[11, 10]["n_words"]) == (33, 80, 60)
    # Repeats inside one document, short and null texts have none.
    assert not {1, 2, 3, 7, 8, 9, 14, 15} & {i for pair in shared for i in pair}
    assert passages.repeated(nothing).count() == 0


def test_passages_are_cut_out_of_their_own_texts_only(spark):
    docs = spark.createDataFrame([(i, " ".join(f"y{i}_{j}" for j in range(30))) for i in range(200)], "doc_id long, text string")
    ends = spark.createDataFrame([(1, i, 0, 2, 9) for i in (3, 150)], "pair long, doc_id long, side int, low int, high int")
    cuts = passages._cut(docs, ends)
    tokens = {i: np.frombuffer(c, np.uint32) for i, c in ((r["doc_id"], r["cut"]) for r in cuts.collect())}
    assert set(tokens) == {3, 150} and all(len(t) == 8 for t in tokens.values())
    # Texts pass the bitmap of ids before they meet the cuts.
    assert "getbit" in cuts._jdf.queryExecution().optimizedPlan().toString()


def test_passages_miss_no_exact_repeat(spark):
    texts = {r["doc_id"]: re.findall(WORD, lower(r["text"])) for r in queries.table(spark, SMALL, "documents").collect()}
    seen: dict[tuple, set] = {}
    for i, w in texts.items():
        for at in range(len(w) - 49):
            seen.setdefault(tuple(w[at : at + 50]), set()).add(i)
    want = {i for s in seen.values() if len(s) > 1 for i in s}
    rows = queries.op6_passages(spark, SMALL).collect()
    assert want <= {i for r in rows for i in (r["doc_id"], r["other_id"])}
    for r in rows:
        a, b = (texts[r[d]][r[s] : r[s] + r["n_words"]] for d, s in (("doc_id", "start_word"), ("other_id", "other_start_word")))
        x, y = ([tuple(v[j : j + 5]) for j in range(len(v) - 4)] for v in (a, b))
        same = sum(p == q for p, q in zip(x, y, strict=True))
        assert same / (2 * len(x) - same) >= 0.75 - 1e-9


def test_compact_windows_cover_every_run():
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.integers(1, 30, 120, dtype=np.uint64), [0], rng.integers(1, 1 << 60, 60, dtype=np.uint64), [0]]).astype(np.uint64)
    width = 9
    got = list(zip(*passages.compact_windows(values, width), strict=True))
    for low in range(len(values) - width + 1):
        run = values[low : low + width]
        if (run == 0).any():
            continue
        holds = [(p, a, b) for p, a, b in got if a <= low <= p < low + width <= b + 1]
        assert [p for p, _, _ in holds] == [low + int(run.argmin())]


@pytest.mark.parametrize("name", ["op2_decontamination", "op4_near_duplicates"])
def test_queries_equal_their_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    cursor = db.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def contamination(text: str | None, items: list[tuple]) -> tuple[int, int, list]:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w = re.findall(word, lower(text))
    hit, named = set(), set()
    for item, t in items:
        v = re.findall(word, lower(t))
        n = min(10, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                if item is not None:
                    named.add(item)
    return len(w), len(hit), sorted(named)


def test_decontamination_of_defined_cases(spark, documents, nothing, texts):
    by_id = dict(texts)
    items = [
        (1, " ".join(by_id[10].split()[90:101])), (2, "ONE two"), (3, "one"), (4, None), (5, ""), (6, "été 世界"), (7, "7 7 7"),
        (8, " ".join(by_id[12].split()[3:13])), (8, "one"), (None, "two"), (9, " ".join(["7"] * 12)), (10, "straße ÉTÉ"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find(documents, benchmark).collect()
    want = sorted((str(i), *contamination(t, items)) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], sorted(r["items"])) for r in got) == want
    kept = decontaminate.keep(documents, benchmark)
    assert kept.columns == documents.columns
    clean = sorted(str(i) for i, t in texts if not contamination(t, items)[1])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == clean
    assert decontaminate.find(nothing, benchmark).count() == 0
    assert decontaminate.find(documents, benchmark.filter("false")).agg(F.sum("n_hit")).first()[0] == 0


def test_decontamination_stays_in_the_engine(documents, spark):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    plan = decontaminate.find(documents, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def neighbours(vectors: dict[int, np.ndarray], asked: list[int], k: int) -> dict[int, list]:
    out = {}
    for q in asked:
        near = [(-float((v * vectors[q]).sum()), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])]
        out[q] = [i for _, i in sorted(near)[:k]]
    return out


def test_neighbours_recall(spark):
    rows = queries.table(spark, "/root/testdata/sf0.01", "embeddings").collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in rows}
    want = neighbours(vectors, [i for i in vectors if i % 20 == 0], 20)
    found: dict[int, list] = {}
    for r in queries.op5_nearest_neighbours(spark, "/root/testdata/sf0.01").collect():
        assert r["score"] == pytest.approx(float((vectors[r["query_id"]] * vectors[r["vec_id"]]).sum()), rel=1e-12)
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(found) == set(want)
    shared = sum(len(set(found[q]) & set(want[q])) for q in want)
    assert shared >= 0.98 * sum(map(len, want.values()))


def test_neighbours_of_defined_cases(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.standard_normal(70)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]
    rows += [(200, None), (220, []), (240, [0.0] * 70), (260, [float("nan")] * 70), (280, [float("inf")] + [1.0] * 69),
             (300, [None] + [1.0] * 69), (320, [1.0, 2.0]), (321, [2.0, 1.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 0.5, 1) for i, v in rows], "vec_id long, embedding array<double>, score double, rank int")
    settings = nearest.Settings(block=16, query_block=2)
    got: dict[int, list] = {}
    for r in nearest.search(df, F.col("vec_id") % 20 == 0, 5, settings).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    sound = {i: np.array(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    want = {q: w for q, w in neighbours(sound, [i for i in sound if i % 20 == 0], 5).items()}
    assert got == want
    assert nearest.search(df.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


def _words(rng, n: int) -> list[str]:
    return [f"v{i}" for i in rng.integers(0, 1 << 40, n)]


def _sides(row, texts) -> tuple[list[str], list[str]]:
    a, b = row["passage_start"], row["other_passage_start"]
    return texts[row["doc_id"]][a : a + row["passage_words"]], texts[row["other_id"]][b : b + row["other_passage_words"]]


def _covered(rows, texts, a: int, b: int, passage: list[str]) -> bool:
    """A row of a and b has all of the passage's own words on both sides, or all but a few."""
    for r in rows:
        if (r["doc_id"], r["other_id"]) == (max(a, b), min(a, b)):
            x, y = _sides(r, texts)
            if min(len(set(passage) & set(v)) for v in (x, y)) >= len(passage) - 1:
                return True
    return False


def _passages_of(spark, texts: dict[int, list[str]]) -> list:
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string").repartition(4)
    rows = passages.repeated(df).collect()
    for r in rows:
        x, y = (shingle_set(" ".join(v)) for v in _sides(r, texts))
        assert min(r["passage_words"], r["other_passage_words"]) >= 50
        assert len(x & y) / len(x | y) == pytest.approx(r["passage_similarity"]) and r["passage_similarity"] >= 0.75 - 1e-9
        assert 0 <= r["start_word"] - r["passage_start"] <= r["passage_words"] - r["n_words"]
    return rows


@pytest.mark.parametrize("size", [50, 60, 80])
def test_passages_with_a_word_more_or_less(spark, size):
    rng = np.random.default_rng(size)
    texts, pairs = {}, []
    for n in range(60):
        passage = _words(rng, size)
        at = int(rng.integers(size // 4, 3 * size // 4))
        # A deleted word leaves as many words as the shortest passage has.
        changed = passage[:at] + (_words(rng, 1) + passage[at:] if n % 2 or size == 50 else passage[at + 1 :])
        for i, middle in ((2 * n, passage), (2 * n + 1, changed)):
            texts[i] = _words(rng, 40) + middle + _words(rng, 40)
        pairs.append((2 * n, 2 * n + 1, passage))
    rows = _passages_of(spark, texts)
    assert sum(_covered(rows, texts, *p) for p in pairs) >= 0.95 * len(pairs)
    assert {r["doc_id"] // 2 for r in rows} == {r["other_id"] // 2 for r in rows}


@pytest.mark.parametrize("part", [30, 40, 45, 48])
def test_passages_that_a_document_of_smaller_id_has_in_part(spark, part):
    rng = np.random.default_rng(part)
    texts, pairs = {}, []
    for n in range(30):
        passage = _words(rng, 50)
        texts[3 * n] = _words(rng, 40) + passage[:part] + _words(rng, 40)
        for i in (1, 2):
            texts[3 * n + i] = _words(rng, 40) + passage + _words(rng, 40)
        pairs.append((3 * n + 1, 3 * n + 2, passage))
    rows = _passages_of(spark, texts)
    assert all(_covered(rows, texts, *p) for p in pairs)


def test_passages_behind_one_line_of_many_documents(spark):
    """More windows of one token than a block holds, in pairs and each other's strangers."""
    rng = np.random.default_rng(5)
    line, texts, pairs = _words(rng, 35), {}, []
    for n in range(400):
        more = _words(rng, 15)
        for i in (n, 400 + n):
            texts[i] = _words(rng, 40) + line + more + _words(rng, 40)
        pairs.append((n, 400 + n, line + more))
    rows = _passages_of(spark, texts)
    assert all(_covered(rows, texts, *p) for p in pairs)
    assert {(r["doc_id"], r["other_id"]) for r in rows} == {(400 + n, n) for n in range(400)}


def test_passages_where_an_id_stands_on_rows_of_different_texts(spark):
    """The text that stands for an id is compared like any other; the rest has no say."""
    rng = np.random.default_rng(11)
    rows, lone, pairs = [], {}, []
    for n in range(20):
        passage = _words(rng, 60)
        lone[2 * n] = _words(rng, 40) + passage + _words(rng, 40)
        lone[2 * n + 1] = _words(rng, 30) + passage
        pairs.append((2 * n, 2 * n + 1, passage))
    rows = [(i, " ".join(w)) for i, w in lone.items()]
    # Longer and shorter texts, empty and none, and a row that is there thrice.
    for n in range(20):
        rows += [(2 * n, " ".join(_words(rng, 90 if n % 2 else 200))), (2 * n + 1, ""), (2 * n + 1, None)]
        rows += [(2 * n + 1, rows[2 * n + 1][1])] * (2 if n % 3 == 0 else 0)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = {r["doc_id"]: (r["text"] or "").split() for r in passages._documents(df).collect()}
    assert set(kept) == set(lone) and passages._documents(df).count() == len(lone)
    assert all(kept[2 * n + 1] == lone[2 * n + 1] for n in range(20))
    found = passages.repeated(df).collect()
    want = [p for p in pairs if kept[p[0]] == lone[p[0]]]
    assert 2 <= len(want) < len(pairs)
    assert all(_covered(found, kept, *p) for p in want)
    assert {(r["doc_id"], r["other_id"]) for r in found} == {(b, a) for a, b, _ in want}
    single = spark.createDataFrame([(i, " ".join(w)) for i, w in kept.items()], df.schema)
    assert set(found) == set(passages.repeated(single).collect())
