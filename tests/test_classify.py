from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.functions import classify, numeric


def test_price_bucket_edges(column):
    edges = [2999, 14999, 15000, 29999, 30000, 49999, 50000, 79999, 80000, 2000001, None]
    got = column(edges, "int", classify.price_bucket(F.col("x")))
    assert got == [
        "Under 15k", "Under 15k", "15k - 30k", "15k - 30k", "30k - 50k", "30k - 50k",
        "50k - 80k", "50k - 80k", "80k+", "80k+", "Unknown",
    ]


def test_fractional_prices_fall_between_buckets(column):
    got = column([29999.5, 14999.5], "double", classify.price_bucket(F.col("x")))
    assert got == ["Unknown", "Under 15k"]


def test_tiers_and_segments(column):
    edges = [2.0, 2.004, 5.0, 5.005, 8.0, 10.0, 10.1, 15.0, 15.004, None]
    tiers = column(edges, "double", classify.commute_tier(F.col("x")))
    assert [t[0] for t in tiers] == ["1", "2", "2", "3", "3", "4", "4", "4", "5", "U"]
    segments = column(edges, "double", classify.location_segment(F.col("x")))
    assert segments == [
        "Core CBD / Inner Ring", "Core CBD / Inner Ring", "Core CBD / Inner Ring",
        "Mid-Ring Suburb", "Mid-Ring Suburb", "Mid-Ring Suburb", "Commuter Zone",
        "Commuter Zone", "Satellite Town", "Satellite Town",
    ]


def test_value_zone(spark):
    rows = [
        (80000, 5.0), (80000, 5.004), (79999, 5.0), (49999, 8.0), (49999, 8.004),
        (50000, 8.0), (20000, 15.0), (20000, 15.004), (None, 3.0), (20000, None),
    ]
    df = spark.createDataFrame(rows, "p int, d double")
    got = [r[0] for r in df.select(classify.value_zone(F.col("p"), F.col("d"))).collect()]
    assert got == [
        "Premium", "Mid-range", "Mid-range", "Sweet Spot", "Mid-range",
        "Mid-range", "Mid-range", "Commuter", "Unknown", "Unknown",
    ]


def test_sweet_spot(spark):
    rows = [
        ("Sweet Spot", 0, 34999, 40000.0), ("Sweet Spot", 0, 35000, 40000.0),
        ("Sweet Spot", 1, 40000, 40000.0), ("Sweet Spot", 1, 40001, 40000.0),
        ("Sweet Spot", None, 20000, 40000.0), ("Sweet Spot", 2, 20000, None),
        ("Mid-range", 2, 20000, 40000.0),
    ]
    df = spark.createDataFrame(rows, "z string, b int, p int, m double")
    got = [
        r[0]
        for r in df.select(
            classify.is_sweet_spot(F.col("z"), F.col("b"), F.col("p"), F.col("m"))
        ).collect()
    ]
    assert got == [True, False, True, False, False, False, False]


def test_verdict_order(spark):
    rows = [(60.0, 8.0, 90000.0), (59.9, 5.0, 50000.0), (0.0, 8.0, 39999.0),
            (0.0, 12.1, 19999.0), (0.0, 8.0, 40000.0), (None, None, None)]
    df = spark.createDataFrame(rows, "s double, d double, m double")
    got = [
        r[0] for r in df.select(classify.verdict(F.col("s"), F.col("d"), F.col("m"))).collect()
    ]
    assert got == [
        "Project Star", "Premium Location", "Good Value", "Budget Commuter", "Average", "Average",
    ]


def test_labels(column):
    assert column([0, 1, 2, 3, 4, 20, None], "int", classify.bedroom_label(F.col("x"))) == [
        "Studio", "1 BR", "2 BR", "3 BR", "4+ BR", "4+ BR", "Unknown",
    ]
    assert [c[0] for c in column([15, 14, 5, 4], "int", classify.data_confidence(F.col("x")))] == [
        "H", "M", "M", "L",
    ]


def test_rounding_half_up(column):
    got = column([1.005, 2.675, -1.005, None], "double", numeric.round_to(F.col("x"), 2))
    assert [None if v is None else str(v) for v in got] == ["1.01", "2.68", "-1.01", None]
    assert [str(v) for v in column([1.005, 2.649], "double", numeric.km(F.col("x")))] == [
        "1.01", "2.65",
    ]


def test_ratios_guard_their_base(spark):
    df = spark.createDataFrame([(5, 0.0), (5, None), (150, 100.0)], "v int, b double")
    got = [r[0] for r in df.select(numeric.pct_of(F.col("v"), F.col("b"))).collect()]
    assert got[:2] == [None, None] and float(got[2]) == 50.0
    none = spark.range(1).select(numeric.share_pct(F.lit(0), F.lit(0))).first()[0]
    assert none is None
