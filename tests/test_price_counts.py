"""Marts from changes of loads against marts from the listings."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest

from rentlens.plans.price_counts import PriceCounts

SHAPE = "property_id string, neighbourhood string, scraped_date date, price_ksh int, bedrooms int, firehose_arrival_at timestamp_ntz"


def loads(seed, n=4):
    draw, found = random.Random(seed), []
    for load in range(n):
        rows = {}
        for _ in range(40):
            key = f"p{draw.randrange(60)}"
            stamp = dt.datetime(2024, 1, 1 + load * 5) + dt.timedelta(hours=draw.randrange(150))  # loads overlap
            day = draw.choice([None, dt.date(2024, 1, 31), dt.date(2024, 2, 1)])
            rows[key] = (key, draw.choice(["A", "B", None]), day, draw.choice([3000, 3001, 9000, draw.randrange(3000, 9000)]), draw.choice([None, 1, 2]), stamp)
        found.append([*rows.values()])
    return found


def latest(parts):
    best = {}
    for i, part in enumerate(parts):
        for r in part:
            if r[0] not in best or (r[5], i) >= best[r[0]][0]:
                best[r[0]] = ((r[5], i), r)
    return [r for _, r in best.values()]


def expected(rows):
    found = {}
    for name in {r[1] for r in rows if r[1] is not None}:
        prices = [r[3] for r in rows if r[1] == name]
        found[name] = (len(prices), int(np.floor(np.mean(prices) + 0.5)), min(prices), max(prices), float(np.floor(np.percentile(prices, 50) + 0.5)))
    return found


def marts(counts):
    return {
        r["neighbourhood"]: (r["total_listings"], r["avg_rent_ksh"], r["min_rent_ksh"], r["max_rent_ksh"], r["median_rent_ksh"])
        for r in counts.mart("neighbourhood").collect()
    }


@pytest.mark.parametrize("seed", range(2))
def test_loads_give_the_marts_of_all_listings(spark, tmp_path, seed):
    parts = loads(seed)
    counts = PriceCounts(spark, str(tmp_path / "c"), folded_after=2)
    for i, part in enumerate(parts, start=1):
        counts.apply(spark.createDataFrame(part, SHAPE), i)
        assert marts(counts) == expected(latest(parts[:i]))
        counts.apply(spark.createDataFrame(part, SHAPE), i)  # again: nothing changes
        assert marts(counts) == expected(latest(parts[:i]))
    assert len(counts.changes.commits()) <= 3


def test_a_load_that_broke_off_is_done_again(spark, tmp_path):
    parts = loads(7)
    counts = PriceCounts(spark, str(tmp_path / "c"))
    counts.apply(spark.createDataFrame(parts[0], SHAPE), 1)
    rows = spark.createDataFrame(parts[1], SHAPE)
    counts.changes.upsert(counts.changed(counts.newer(rows, 2)), 2)  # its listings were not stored
    counts.apply(rows, 2)
    assert marts(counts) == expected(latest(parts[:2]))


def test_a_load_reads_no_earlier_load(spark, tmp_path):
    counts = PriceCounts(spark, str(tmp_path / "c"))
    for i, part in enumerate(loads(3, 3), start=1):
        spark.createDataFrame(part, SHAPE).write.parquet(str(tmp_path / f"load{i}"))
        rows = spark.read.parquet(str(tmp_path / f"load{i}"))
        newer = counts.newer(rows, i)
        read = {f.split("/part-")[0].rsplit("/", 1)[1] for f in newer.inputFiles()}
        known = {f"attempt={c.attempt}" for c in counts.listings.commits()}
        assert read == {f"load{i}", *known} and len(known) == min(1, i - 1)
        counts.apply(rows, i)
