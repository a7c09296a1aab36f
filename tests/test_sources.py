from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rentlens.operators.spool import clear_spool, spool, spool_folder
from rentlens.schema import CANONICAL
from rentlens.session import require_shared, shared_folder
from rentlens.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def numbers(spark, n=1000):
    return spark.range(n).select((F.col("id") % 10).alias("k"), "id")


def test_published_view_stays_lazy(spark):
    view = tables.publish(numbers(spark), "numbers_view")
    assert "Range" in plan_of(view) and view.count() == 1000


def test_bucketed_table_groups_without_a_shuffle(spark, tmp_path):
    stored = tables.publish(
        numbers(spark), "numbers_bucketed", "table", path=str(tmp_path / "t"),
        sort_by=["k"], bucket_by=(4, "k"),
    )
    counted = stored.groupBy("k").count()
    assert "Exchange" not in plan_of(counted)
    assert {r["count"] for r in counted.collect()} == {100}


def test_spread_and_sorted_table(spark, tmp_path):
    stored = tables.publish(
        numbers(spark), "numbers_spread", "table", path=str(tmp_path / "t"),
        sort_by=["k"], spread=3,
    )
    assert len(list(Path(tmp_path / "t").glob("part-*"))) == 3
    assert stored.count() == 1000
    # Published again with other rows: replaced as a whole.
    again = tables.publish(numbers(spark, 10), "numbers_spread", "table", path=str(tmp_path / "u"))
    assert again.count() == 10


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="unknown kind"):
        tables.publish(numbers(spark), "x", "cube")


def test_column_listing(spark):
    tables.publish(numbers(spark), "numbers_listed")
    got = [tuple(r) for r in tables.column_listing(spark, "numbers_listed").collect()]
    assert got == [("k", "bigint", 1), ("id", "bigint", 2)]


def test_archive_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = spark.range(100).select(
        *[
            (F.col("id").cast("string") if f.name == "property_id" else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in CANONICAL.fields
        ],
        F.lit("s").alias("_shard"),
        F.col("id").cast("string").alias("_seq"),
        F.lit(0.0).alias("_arrival"),
        (F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.col("id") % 5, F.col("id") % 2)).alias("at"),
    )
    tables.write_archive(rows, path, F.col("at"), files_per_hour=2)
    for folder in Path(path).glob("year=*/month=*/day=*/hour=*"):
        assert len(list(folder.glob("part-*"))) <= 2
    day = tables.read_archive(spark, path).filter("day = '03' AND hour = '01'")
    assert day.count() == 10
    assert day.select("day").distinct().first()[0] == "03"
    assert "PartitionFilters: [isnotnull(day" in plan_of(day)


def test_spool_is_read_by_column_and_cleared(spark):
    stored = spool(numbers(spark))
    assert stored.dtypes == numbers(spark).dtypes
    assert "ReadSchema: struct<k:bigint>" in plan_of(stored.select("k"))
    folder = Path(spool_folder(spark).removeprefix("file:"))
    assert folder.exists()
    clear_spool(spark)
    assert not folder.exists()
    assert spool(numbers(spark)).count() == 1000


def test_shared_folder_is_probed(spark):
    require_shared(spark)
    leftovers = [p.name for p in Path(shared_folder(spark)).iterdir() if p.name.startswith("probe-")]
    assert not leftovers


def test_buckets_follow_the_size(spark):
    assert tables.buckets_for(numbers(spark)) == 8
    assert tables.buckets_for(numbers(spark, 1_000_000), bytes_each=1 << 18) > 8


def rows_scanned(df):
    """What the scan gave to the filter above it: rows of blocks that were not skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_lookups_skip_blocks(spark, tmp_path):
    n = 400_000
    rows = spark.range(n).select(
        F.concat(F.lit("brk-"), F.sha1(F.col("id").cast("string"))).alias("property_id"),
        F.concat(F.lit("place "), (F.col("id") * 7919 % 997).cast("string")).alias("neighbourhood"),
        (F.col("id") % 50_000).cast("int").alias("price_ksh"),
    )
    path = str(tmp_path / "t")
    tables.write_lookups(rows, path, "property_id", "neighbourhood", block_bytes=256 << 10, distinct=8_000)
    stored = spark.read.parquet(path)
    wanted = [r["property_id"] for r in rows.filter("id % 150000 = 77").collect()]
    found = tables.look_up(stored, "property_id", wanted)
    assert sorted(r["property_id"] for r in found.collect()) == sorted(wanted)
    assert rows_scanned(found) < n / 10
    near = tables.look_up(stored, "neighbourhood", ["place 500"])
    assert near.count() == rows.filter("neighbourhood = 'place 500'").count()
    assert rows_scanned(tables.look_up(stored, "neighbourhood", ["place 500"])) < n / 10
    none = tables.look_up(stored, "property_id", ["brk-none"])
    assert none.count() == 0 and rows_scanned(none) < n / 10
    assert tables.look_up(stored, "property_id", []).collect() == []
