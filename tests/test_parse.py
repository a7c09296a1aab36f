from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from rentlens.functions import parse, text


def test_prices(column):
    texts = ["KSh 45,000 per month", "85000.00", "Price on call", None, "", "Price: 30k",
             "KSh 1,250,000.75", "from 20,000 to 30,000", "99999999999999"]
    got = column(texts, "string", parse.price(F.col("x")))
    assert got == [45000, 85000, None, None, None, 30, 1250000, 20000, None]


def test_price_with_k_suffix(column):
    texts = ["30k", "30K per month", "30 km away", "KSh 45,000", "2.5k", "none"]
    got = column(texts, "string", parse.price(F.col("x"), k_suffix=True))
    assert got == [30000, 30000, 30, 45000, 2500, None]


@pytest.mark.parametrize(
    "title, description, expected",
    [
        ("Stunning 2 bedroom apartment", "Spacious lounge", 2),
        ("Executive 1 bd studio flat", "Fully furnished", 0),
        ("Beautiful house", "Features 4 beds with SQ", 4),
        ("Modern rental", "No mention here", None),
        ("3BED flat", None, 3),
        (None, "bedsitter", None),
        ("2 BR flat", "", None),
    ],
)
def test_bedrooms(spark, title, description, expected):
    df = spark.createDataFrame([(title, description)], "t string, d string")
    assert df.select(parse.bedrooms(F.col("t"), F.col("d"))).first()[0] == expected


def test_stable_id(column):
    url = "https://listings.example/é/1"
    want = "brk-" + hashlib.md5(url.encode()).hexdigest()[:12]
    assert column([url, "", None], "string", parse.stable_id(F.col("x"), "brk-")) == [
        want, None, None,
    ]


def test_first_non_empty_keeps_zero(spark):
    df = spark.createDataFrame([("", "0", "b"), (None, "", None)], "a string, b string, c string")
    got = df.select(
        text.first_non_empty(F.col("a"), F.col("b"), F.col("c"), default="none").alias("y")
    ).collect()
    assert [r["y"] for r in got] == ["0", "none"]


def test_trim_removes_spaces_only(column):
    got = column(["", "   ", None, "\t", "  a "], "string", text.trimmed_or(F.col("x"), "Unknown"))
    assert got == ["Unknown", "Unknown", "Unknown", "\t", "a"]


def test_proper_case_splits_on_spaces(column):
    got = column(["upper-hill", "  SOUTH b "], "string", text.proper_case(F.col("x")))
    assert got == ["Upper-hill", "South B"]


def test_tooltip_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("Ngara", "1 BR", 5), (None, "1 BR", 5)], "n string, b string, p int")
    got = df.select(text.tooltip(F.col("n"), F.col("b"), F.col("p")).alias("y")).collect()
    assert [r["y"] for r in got] == ["Ngara - 1 BR (5 KSh)", None]
