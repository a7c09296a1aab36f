from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS
from rentlens.functions.geo import geodesic_km, geodesic_m
from rentlens.sources.gazetteer import PLACES, gazetteer


def distance(df):
    return df.withColumn(
        "km",
        geodesic_km(F.col("lat"), F.col("lon"), DEFAULTS.origin_lat, DEFAULTS.origin_lon),
    )


def test_known_distance_and_nulls(spark):
    rows = [(-1.2741, 36.8245), (DEFAULTS.origin_lat, DEFAULTS.origin_lon), (None, 36.8), (0.0, 0.0)]
    got = [r["km"] for r in distance(spark.createDataFrame(rows, "lat double, lon double")).collect()]
    assert got[:3] == [1.214, 0.0, None]
    # Published WGS-84 distances grow with the longitude: 111.3195 km a degree at the equator.
    assert got[3] == pytest.approx(4101, abs=3)


# Published inverse problems on WGS-84: latitude, latitude, degrees of longitude between
# them, metres, and the digits that are published.
OPPOSITE = [
    (-30.0, 29.9, 179.8, 19989832.827610, 0.001),
    (0.0, 0.5, 179.5, 19936288.578965, 0.001),
    (88.202499451857, -88.202499451857, 179.981022032992859592, 20003898.214, 0.001),
    (89.262080389218, -89.262080389218, 179.992207982775375662, 20003925.854, 0.001),
    (89.333123580033, -89.333123580032997687, 179.99295812360148422, 20003926.881, 0.001),
    (56.320923501171, -56.320923501171, 179.664747671772880215, 19993558.287, 0.001),
    (52.784459512564, -52.784459512563990912, 179.634407464943777557, 19991596.095, 0.001),
    (48.522876735459, -48.52287673545898293, 179.599720456223079643, 19989144.774, 0.001),
    (0.0, 0.0, 179.0, 19926189.0, 0.5),
    (0.0, 0.0, 179.5, 19980862.0, 0.5),
    (0.0, 0.0, 180.0, 20003931.0, 0.5),
    (0.0, 1.0, 180.0, 19893357.0, 0.5),
]


def test_opposite_points_match_published_distances(spark):
    rows = [(a, b, turn) for a, b, turn, *_ in OPPOSITE]
    df = spark.createDataFrame(rows, "a double, b double, turn double")
    there = geodesic_m(F.col("b"), F.col("turn"), F.col("a"), F.lit(0.0))
    back = geodesic_m(F.col("a"), F.lit(-10.0), F.col("b"), F.col("turn") - 10.0)
    west = geodesic_m(-F.col("b"), 360.0 - F.col("turn"), -F.col("a"), F.lit(0.0))
    got = df.select(there.alias("there"), back.alias("back"), west.alias("west")).collect()
    for row, (*_, metres, digits) in zip(got, OPPOSITE, strict=True):
        assert list(row) == pytest.approx([metres] * 3, abs=digits)


def test_both_ways_of_solving_meet_where_they_change(spark):
    rows = [(lat / 3, 160.0 + lon / 7) for lat in range(-45, 46, 5) for lon in range(140)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    step = geodesic_m(F.col("lat") + 1e-7, F.col("lon"), -12.0, 0.0)
    off = df.select(F.max(F.abs(step - geodesic_m(F.col("lat"), F.col("lon"), -12.0, 0.0)))).first()[0]
    # 1e-7 degrees are 11 mm on the ground, so no distance may differ by more.
    assert 0 < off < 0.0125


def test_points_across_the_date_line(spark):
    df = spark.createDataFrame([(1.0, -179.5), (1.0, 180.5)], "lat double, lon double")
    got = [r[0] for r in df.select(geodesic_km(F.col("lat"), F.col("lon"), 1.0, 179.5)).collect()]
    assert got[0] == got[1] == pytest.approx(111.303, abs=0.001)


def test_equator_degree(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "lat double, lon double")
    km = df.select(geodesic_km(F.col("lat"), F.col("lon"), 0.0, 0.0)).first()[0]
    assert km == pytest.approx(111.319, abs=0.001)


def test_all_places_near_the_sphere_distance(spark):
    rows = distance(gazetteer(spark)).collect()
    assert len(rows) == len(PLACES) == 89
    for r in rows:
        a, b = map(math.radians, (DEFAULTS.origin_lat, r["lat"]))
        d = math.radians(r["lon"] - DEFAULTS.origin_lon)
        h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(d / 2) ** 2
        sphere = 2 * 6371.0088 * math.asin(math.sqrt(h))
        assert abs(r["km"] - sphere) <= max(0.0056 * sphere, 0.001) + 0.001
