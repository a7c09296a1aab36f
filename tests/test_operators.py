from __future__ import annotations

import random
import threading
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentlens.operators import dedupe, filters, upsert
from rentlens.operators.percentiles import grouped_percentiles
from rentlens.operators.ranking import RankBy, with_positions, with_ranks
from rentlens.operators.upsert import KeyedTable


def test_latest_per_key(spark):
    rows = [
        ("a", "2026-01-01", "x"), ("a", "2026-01-02", "y"), ("a", "2026-01-02", "z"),
        ("b", None, "only"), ("c", None, "null"), ("c", "2026-01-01", "dated"),
        ("d", "2026-01-01", None), ("d", "2026-01-01", "content"),
    ]
    df = spark.createDataFrame(rows, "k string, t string, v string")
    want = {"a": "z", "b": "only", "c": "dated", "d": "content"}
    for parts in (1, 7):
        got = dedupe.latest_per_key(df.repartition(parts), ["k"], ["t"])
        assert {r["k"]: r["v"] for r in got.collect()} == want
        assert got.columns == df.columns


def test_latest_by_aggregate_agrees(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(9), draw.randrange(5), draw.randrange(100)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    window = dedupe.latest_per_key(df, ["k"], ["t"]).collect()
    assert sorted(window) == sorted(dedupe.latest_by_aggregate(df, ["k"], ["t"]).collect())


def test_merge_latest(spark):
    left = spark.createDataFrame([("a", 1, "l"), ("b", 5, "l")], "k string, t int, v string")
    right = spark.createDataFrame([("a", 2, "r"), ("c", 1, "r")], "k string, t int, v string")
    got = dedupe.merge_latest(left, right, ["k"], ["t"]).collect()
    assert sorted((r["k"], r["v"]) for r in got) == [("a", "r"), ("b", "l"), ("c", "r")]


def test_percentiles_against_numpy(spark):
    draw = random.Random(2)
    # One group holds most rows, and prices repeat.
    rows = [
        ("hot" if draw.random() < 0.7 else draw.choice("abc"), draw.randrange(3000, 3100),
         draw.random() < 0.3)
        for _ in range(3000)
    ] + [("single", 5, False), ("nulls", None, True)]
    df = spark.createDataFrame(rows, "g string, x int, f boolean")
    got = grouped_percentiles(
        df, ["g"], F.col("x"), {"p25": 0.25, "p50": 0.5, "p75": 0.75},
        subset=F.col("f"), subset_points={"s50": 0.5},
    ).collect()
    assert {r["g"] for r in got} == {"hot", "a", "b", "c", "single", "nulls"}
    for r in got:
        values = [x for g, x, _ in rows if g == r["g"] and x is not None]
        flagged = [x for g, x, f in rows if g == r["g"] and f and x is not None]
        if values:
            assert [r["p25"], r["p50"], r["p75"]] == pytest.approx(
                np.percentile(values, [25, 50, 75])
            )
        else:
            assert r["p50"] is None
        assert r["s50"] == (pytest.approx(np.median(flagged)) if flagged else None)


def test_ranks_over_ranges(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice([None, 1.0, 1.0, 2.5, draw.random()]), draw.randrange(4)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b int")
    ranks = [RankBy("up", "a"), RankBy("down", "a", descending=True), RankBy("b_rank", "b")]
    small = sorted(with_ranks(df, ranks).collect())
    present = [r for r in small if r["a"] is not None]
    for r in small:
        if r["a"] is None:
            assert r["up"] == r["down"] == len(present) + 1
        else:
            assert r["up"] == 1 + sum(o["a"] < r["a"] for o in present)
            assert r["down"] == 1 + sum(o["a"] > r["a"] for o in present)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


@pytest.mark.parametrize(
    "stage, want",
    [
        ([], [("a", 1), ("a", 2), ("b", 3)]),
        ([("c", 9)], [("a", 1), ("a", 2), ("b", 3), ("c", 9)]),
        ([("a", 7), ("b", 8)], [("a", 7), ("b", 8)]),
        # Repeats inside the stage all land.
        ([("a", 7), ("a", 7)], [("a", 7), ("a", 7), ("b", 3)]),
    ],
)
def test_upsert(spark, tmp_path, stage, want):
    target = frame(spark, [("a", 1), ("a", 2), ("b", 3)])
    staged = frame(spark, stage)
    once = upsert.upsert(target, staged, ["k"])
    assert sorted(tuple(r) for r in once.collect()) == want

    table = KeyedTable(spark, str(tmp_path / "t"), target.schema, ["k"])
    assert table.read().count() == 0
    table.upsert(target, 1)
    for _ in range(2):
        table.upsert(staged, 2)
        assert sorted(tuple(r) for r in table.read().collect()) == want
    table.compact(keep=0)
    assert [c.key for c in table.commits()] == ["folded"]
    assert sorted(tuple(r) for r in table.read().collect()) == want
    table.upsert(frame(spark, [("b", 100)]), 3)
    assert ("b", 100) in [tuple(r) for r in table.read().collect()]


def test_only_committed_rows_are_read(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), frame(spark, []).schema, ["k"])
    table.upsert(frame(spark, [("a", 1)]), "one")
    attempt = table.stage(frame(spark, [("a", 2)]))
    assert [tuple(r) for r in table.read().collect()] == [("a", 1)]
    table.commit(attempt, "two")
    assert [tuple(r) for r in table.read().collect()] == [("a", 2)]
    # A repeated write keeps its place before the later one.
    table.upsert(frame(spark, [("a", 9), ("b", 9)]), "one")
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 2), ("b", 9)]


def test_folding_keeps_the_newest_and_expires(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), frame(spark, []).schema, ["k"])
    for i in range(5):
        table.upsert(frame(spark, [("a", i), (f"k{i}", i)]), i)
    table.compact(keep=1, where=F.col("v") >= 2)
    assert [c.key for c in table.commits()] == ["folded", "4"]
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 4), ("k2", 2), ("k3", 3), ("k4", 4)]
    table.upsert(frame(spark, [("a", 40)]), 4)
    assert ("a", 40) in [tuple(r) for r in table.read().collect()]
    folders = [p for p in (tmp_path / "t").iterdir() if p.name.startswith("attempt=")]
    assert len(folders) == len(table.commits())


def test_two_writers_get_two_numbers(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), frame(spark, []).schema, ["k"])
    attempts = [table.stage(frame(spark, [("a", i), (f"k{i}", i)])) for i in range(6)]
    start = threading.Barrier(6)

    def commit(i):
        start.wait()
        table.commit(attempts[i], f"writer{i}")

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(commit, range(6)))
    commits = table.commits()
    assert sorted(c.number for c in commits) == [1, 2, 3, 4, 5, 6]
    last = int(commits[-1].key.removeprefix("writer"))
    assert sorted(tuple(r) for r in table.read().collect()) == sorted([("a", last), *[(f"k{i}", i) for i in range(6)]])


def test_folds_stop_at_an_open_claim(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), frame(spark, []).schema, ["k"])
    for i in range(2):
        table.upsert(frame(spark, [("a", i)]), i)
    slow = KeyedTable(spark, table.path, table.schema, ["k"])
    number = slow._claim()
    for i in range(2, 5):
        table.upsert(frame(spark, [("a", i)]), i)
    table.compact(keep=0)
    assert [(c.number, c.key) for c in table.commits()] == [(2, "folded"), (4, "2"), (5, "3"), (6, "4")]
    slow._claim = lambda: number
    slow.upsert(frame(spark, [("b", 9)]), "slow")
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 4), ("b", 9)]
    # A claim that was thought abandoned, and that a fold has gone past, is taken anew.
    table.compact(keep=0)
    again = iter([1, KeyedTable(spark, table.path, table.schema, ["k"])._claim()])
    slow._claim = lambda: next(again)
    slow.upsert(frame(spark, [("a", 77)]), "late")
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 77), ("b", 9)]
    assert [c.key for c in table.commits()] == ["folded", "late"]


def test_larger_versions_win_in_any_order(spark, tmp_path):
    draw = random.Random(5)
    rows = [(draw.choice("abc"), v) for v in range(40)] + [("n", None), ("n", None)]
    draw.shuffle(rows)
    schema = frame(spark, []).schema
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["k"], version=["v"])
    for i in range(0, len(rows), 7):
        part = {}
        for k, v in rows[i : i + 7]:
            part[k] = v if k not in part else max(v, part[k], key=lambda x: -1 if x is None else x)
        table.upsert(frame(spark, [*part.items()]), i)
        if i == 21:
            table.compact()
    want = sorted([(k, max(v for x, v in rows if x == k)) for k in "abc"] + [("n", None)])
    assert sorted(tuple(r) for r in table.read().collect()) == want
    table.compact(keep=0)
    assert sorted(tuple(r) for r in table.read().collect()) == want


def test_positions_are_a_total_order(spark):
    draw = random.Random(4)
    rows = [(draw.choice([None, 1, 2, 3]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, i int")
    got = with_positions(df, "n", F.col("a").asc_nulls_last(), F.col("i").asc()).orderBy("n").collect()
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [(r["a"], r["i"], r["n"]) for r in got] == [(*r, n) for n, r in enumerate(want, start=1)]


def test_required_fields(spark):
    df = spark.createDataFrame(
        [("p", "KSh 1", "Ngara"), ("", None, "Ngara"), (None, "KSh 1", "")],
        "property_id string, price_raw string, location_raw string",
    )
    accepted, rejected = filters.split_required(df)
    assert accepted.count() == 1
    assert sorted(r["error"] for r in rejected.collect()) == [
        "Missing required fields: location_raw, property_id",
        "Missing required fields: price_raw, property_id",
    ]


def test_gate_edges(spark):
    prices = [2999, 3000, 2_000_000, 2_000_001, None]
    df = spark.createDataFrame(
        [("a", "x", p) for p in prices] + [("  ", "x", 5000), (None, "x", 5000), ("a", None, 5000)],
        "property_id string, location_raw string, price_ksh int",
    )
    assert [r["price_ksh"] for r in filters.quality_gate(df).collect()] == [3000, 2_000_000]
