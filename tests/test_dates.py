from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rentlens.functions import convert, dates
from rentlens.plans import gold


def test_utc_day_and_local_time(column):
    texts = ["2026-01-15T22:30:00+00:00", "2026-01-16T01:30:00+03:00", "junk", None]
    observed = column(texts, "string", dates.utc_timestamp(F.col("x")))
    assert observed[:2] == [dt.datetime(2026, 1, 15, 22, 30)] * 2
    assert observed[2:] == [None, None]
    assert column(texts, "string", dates.utc_day(F.col("x")))[0] == dt.date(2026, 1, 15)
    local = column(
        texts, "string", dates.to_zone(dates.utc_timestamp(F.col("x")), "Africa/Nairobi")
    )
    assert local[0] == dt.datetime(2026, 1, 16, 1, 30)


def test_default_calendar(spark):
    calendar = gold.date_dimension(spark)
    assert calendar.count() == 365
    first = calendar.filter("date_id = 20260103").first()
    assert (first["day_name_short"], first["day_of_week_num"], first["is_weekend"]) == (
        "SAT", 6, True,
    )
    assert first["month_year"] == "January 2026"
    assert first["month_start"] == dt.date(2026, 1, 1)


def test_calendar_of_no_days(spark):
    assert dates.calendar(spark, dt.date(2026, 1, 1), dt.date(2026, 1, 1)).count() == 0


def test_expiry(column):
    got = column(["1970-01-02 00:00:00"], "string",
                 dates.expiry_seconds(F.col("x").cast("timestamp_ntz"), 90))
    assert got == [86400 * 91]


def test_nested_floats_become_exact(spark):
    df = spark.createDataFrame(
        [(0.1, [0.2], {"k": 0.3}, 1)], "a double, b array<double>, c map<string,double>, d int"
    )
    row = convert.floats_to_exact(df).first()
    assert (str(row["a"]).rstrip("0"), str(row["b"][0]).rstrip("0")) == ("0.1", "0.2")
    assert str(row["c"]["k"]).rstrip("0") == "0.3"
    assert row["d"] == 1


def test_json_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(convert.record_json("x", "y")).first()[0] == '{"x":"a"}'
