"""Whitened embeddings against plain linear algebra."""

from __future__ import annotations

import math

import numpy as np
import pytest

from rentlens.llm import queries, whitening

SMALL = "/root/testdata/sf0.001"
SHAPE = "vec_id long, embedding array<float>, label int, part int, `index` long, x string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], SHAPE).repartition(parts)


def plain(rows):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n = len(x)
    gaps = n * x - x.sum(axis=0)
    centred = gaps.astype(float) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    return [i for i, _ in kept], (gaps * gaps).sum(axis=1), values, values / np.trace(covariance), centred @ vectors / np.sqrt(np.maximum(values, 1e-300))


def compare(found, rows, most=whitening.COMPONENTS):
    ids, deviations, values, explained, whitened = plain(rows)
    k = min(most, int((values > values.max() * 1e-10).sum()))
    by_id: dict = {}
    for r in found:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(found) == len(ids) * k
    signs = {}
    for j in range(k):
        big = int(np.abs(whitened[:, j]).argmax())
        signs[j] = np.sign(by_id[ids[big]][j + 1]["whitened"] * whitened[big, j])
    for i, vec in enumerate(ids):
        for j in range(k):
            r = by_id[vec][j + 1]
            assert r["n"] == len(ids) and r["deviation"] == deviations[i]
            assert r["whitened"] == pytest.approx(signs[j] * whitened[i, j], rel=1e-7, abs=1e-7)
            assert r["explained"] == pytest.approx(explained[j], rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-9


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    turn = rng.normal(size=(d, d))
    return [(i, [float(c) for c in v]) for i, v in enumerate((rng.normal(size=(n, d)) * np.arange(1, d + 1)) @ turn + 5)]


@pytest.mark.parametrize(("parts", "panel"), [(1, 1 << 26), (5, 1 << 26), (5, 20), (7, 1)])
def test_values_of_parts_and_panels(spark, parts, panel):
    rows = vectors(parts, 60, 5)
    rows += [(100, None), (101, [1.0, float("nan"), 0.0, 0.0, 0.0]), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("inf")] * 5)]
    compare(whitening.whiten(frame(spark, rows, parts), panel_rows=panel).collect(), rows)


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 8)
    monkeypatch.setattr(whitening, "BLOCK_COLS", 3)
    rows = vectors(9, 70, 8)
    compare(whitening.whiten(frame(spark, rows), most=4).collect(), rows, most=4)


def test_defined_cases(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, []), (3, [None])])).collect() == []
    # A dimension that never changes has no component; other lengths take no part.
    rows = [(i, [float(i), 3.0, float(i * i)]) for i in range(9)]
    found = whitening.whiten(frame(spark, [*rows, (50, [1.0]), (51, [])])).collect()
    assert {r["component"] for r in found} == {1, 2}
    compare(found, rows)
    # Repeated rows and null ids are rows.
    found = whitening.whiten(frame(spark, [*rows, rows[0], (None, [9.0, 3.0, 1.0])])).collect()
    assert len(found) == 22 and {r["n"] for r in found} == {11}


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in queries.table(spark, SMALL, "embeddings").collect()]
    compare(queries.op12_whitening(spark, SMALL).collect(), rows)
