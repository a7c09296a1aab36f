from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rentlens import config
from rentlens.operators.upsert import KeyedTable
from rentlens.plans import batch_job, staging, warehouse
from rentlens.quality import gates, rules, suites
from rentlens.registry import base
from rentlens.schema import CANONICAL, CANONICAL_COLUMNS

SMALL = "/root/testdata/sf0.001"
ASOF = dt.datetime(2026, 1, 10)


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, z string, t timestamp_ntz")


CLEAN = [("a", 1, "x", ASOF), ("b", 2, "y", ASOF - dt.timedelta(days=3))]


def asof():
    return F.lit("2026-01-10 00:00:00").cast("timestamp_ntz")


def rule_cases():
    return {
        "row_count": (lambda: rules.row_count_over(1), CLEAN[:1]),
        "complete": (lambda: rules.complete("k"), [*CLEAN, (None, 1, "x", ASOF)]),
        "low": (lambda: rules.in_range("v", low=1), [*CLEAN, ("c", 0, "x", ASOF)]),
        "high": (lambda: rules.in_range("v", high=2), [*CLEAN, ("c", 3, "x", ASOF)]),
        "set": (lambda: rules.in_set("z", ["x", "y"]), [*CLEAN, ("c", 1, "q", ASOF)]),
        "expression": (
            lambda: rules.expression("v + 1 > 1", F.col("v") + 1 > 1),
            [*CLEAN, ("c", None, "x", ASOF)],
        ),
        "recent": (
            lambda: rules.recent_within("t", asof(), 26),
            [("a", 1, "x", ASOF - dt.timedelta(hours=27)), ("b", 1, "x", None)],
        ),
    }


@pytest.mark.parametrize("name", ["row_count", "complete", "low", "high", "set", "expression", "recent"])
def test_rule_passes_clean_and_fires_on_broken(spark, name):
    make, broken = rule_cases()[name]
    assert rules.evaluate(table(spark, CLEAN), "t", [make()]).first()["status"] == "pass"
    assert rules.evaluate(table(spark, broken), "t", [make()]).first()["status"] == "fail"


def test_null_passes_range_and_set_rules(spark):
    rows = table(spark, [("a", None, None, None)])
    report = rules.evaluate(rows, "t", [rules.in_range("v", 1, 2), rules.in_set("z", ["x"])])
    assert {r["status"] for r in report.collect()} == {"pass"}


def test_where_limits_a_rule(spark):
    rows = table(spark, [("a", 9, "x", None), ("b", 9, "y", None), ("c", 9, None, None)])
    rule = rules.in_range("v", high=5, where=F.col("z") == "y")
    assert rules.evaluate(rows, "t", [rule]).first()["failed"] == 1


def test_keys(spark):
    rows = table(spark, [("a", 1, "x", None), ("a", 2, "x", None), (None, 1, "x", None)] + [(None, 1, "x", None)])
    assert rules.unique(rows, "t", "k").first()["failed"] == 1
    assert rules.unique(rows, "t", "k", "v").first()["failed"] == 0
    parents = spark.createDataFrame([("b",)], "id string")
    assert rules.relationship(rows, parents, "t", "k", "id").first()["failed"] == 2


def test_no_rows_is_stale(spark):
    empty = table(spark, [])
    assert rules.evaluate(empty, "t", [rules.recent_within("t", asof(), 26)]).first()["failed"] == 1
    assert rules.freshness(empty, "t", asof(), 25, 49).first()["status"] == "error"


@pytest.mark.parametrize("hours, status", [(25, "pass"), (26, "warn"), (49, "warn"), (50, "error")])
def test_freshness(spark, hours, status):
    rows = table(spark, [("a", 1, "x", ASOF - dt.timedelta(hours=hours))])
    assert rules.freshness(rows, "t", asof(), 25, 49).first()["status"] == status


def test_severity_warn_does_not_halt(spark):
    rows = table(spark, [(None, 1, "x", None)])
    gates.halt_on_failure(rules.evaluate(rows, "t", [rules.complete("k", "warn")]), "stage")
    with pytest.raises(gates.QualityError, match="k complete"):
        gates.halt_on_failure(rules.evaluate(rows, "t", [rules.complete("k")]), "stage")


@pytest.mark.parametrize("stream, batch, is_open", [(0, 1, False), (1, 0, False), (2, 3, True)])
def test_both_inputs_must_be_fresh(spark, stream, batch, is_open):
    old = ASOF - dt.timedelta(hours=5)
    new = ASOF - dt.timedelta(hours=1)
    streamed = spark.createDataFrame(
        [(old,)] + [(new,)] * stream, "firehose_arrival_at timestamp_ntz"
    )
    cleaned = spark.createDataFrame([(old,)] + [(new,)] * batch, "batch_cleaned_at timestamp_ntz")
    row = gates.fresh_counts(streamed, cleaned, asof()).first()
    assert (row["stream_count"], row["batch_count"], row["is_open"]) == (stream, batch, is_open)
    if is_open:
        gates.require_fresh(streamed, cleaned, asof())
    else:
        with pytest.raises(gates.QualityError):
            gates.require_fresh(streamed, cleaned, asof())


#: Every rule of the report, by layer.
RULES = {
    "landed": [
        "row_count > 0", "scraped_at complete", "firehose_arrival_at complete", "observed_at within 26 h",
        "firehose_arrival_at within 25 h", "firehose_arrival_at within 49 h",
    ],
    "staged": [
        "property_id complete", "dist_to_archives_km in 0..100", "value_zone accepted",
        "price_ksh in 3000..2000000", "property_id unique",
    ],
    "enriched": [
        "median > 0", "commute_tier accepted", "location_segment accepted", "is_sweet_spot accepted",
        "bedroom_label accepted", "pct plausible", "geographic_alignment", "neighbourhood_maths", "orphan_medians",
        "percentage_direction", "sweet_spot_rules", "bedroom_pricing",
    ],
    "fact": [
        "property_id complete", "price_ksh complete", "neighbourhood has parent", "scraped_date has parent",
        "property_id, scraped_date unique", "property_id unique", "leakage",
    ],
    "calendar": [
        "date_day complete", "date_day unique",
    ],
    "places": [
        "neighbourhood complete", "commute_tier accepted", "neighbourhood unique",
    ],
    "stats": [
        "neighbourhood complete", "value_rank complete", "neighbourhood unique", "rank_one_benchmarks",
    ],
    "finder": [
        "neighbourhood complete", "overall_value_rank complete", "composite_score complete", "price_rank complete",
        "distance_rank complete", "consistency_rank complete", "verdict complete", "dist_to_archives_km complete",
        "value_zone complete", "median_rent_ksh complete", "avg_rent_ksh complete", "total_listings complete",
        "sweet_spot_pct complete", "overall_value_rank in 1..", "price_rank in 1..", "distance_rank in 1..",
        "consistency_rank in 1..", "composite_score in 0..", "dist_to_archives_km in 0..60",
        "median_rent_ksh in 3000..2000000", "avg_rent_ksh in 3000..2000000", "affordability_index in 0..",
        "iqr_rent_ksh in 0..", "total_listings in 3..", "sweet_spot_pct in 0..100", "verdict accepted",
        "value_zone accepted", "score_deviation", "verdict_contract", "neighbourhood unique", "rank_order",
    ],
    "trends": [
        "neighbourhood complete", "month_start complete",
    ],
    "points": [
        "property_id complete", "dist_to_archives_km complete", "property_id unique",
    ],
}


def test_whole_warehouse_report(spark):
    built = warehouse.build(base.raw(spark, SMALL), base.asof(spark, SMALL))
    report = warehouse.quality_report(built, base.asof(spark, SMALL)).collect()
    assert sorted((r["layer"], r["rule"]) for r in report) == sorted((layer, rule) for layer, rules in RULES.items() for rule in rules)
    failed = {(r["layer"], r["rule"]) for r in report if r["status"] == "fail"}
    # Listings and whole neighbourhoods without a distance are kept and reported.
    assert failed <= {
        ("finder", "dist_to_archives_km complete"), ("enriched", "bedroom_pricing"),
    }


def batch_rows(spark, n=150):
    rows = base.raw(spark, SMALL).select(CANONICAL_COLUMNS)
    return rows.orderBy("ingested_at", "property_id").limit(n)


def tables(spark, tmp_path):
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    shape = staging.batch_cleaned(batch_rows(spark), stamp).schema
    return (
        KeyedTable(spark, str(tmp_path / "raw"), CANONICAL, ["property_id"]),
        KeyedTable(spark, str(tmp_path / "cleaned"), shape, ["property_id"]),
        stamp,
    )


def test_batch_job_is_idempotent(spark, tmp_path):
    raw, cleaned, stamp = tables(spark, tmp_path)
    results = []
    for version in (1, 1, 2):
        batch_job.load_batch(batch_rows(spark), raw, cleaned, version, stamp)
        results.append(
            (sorted(cleaned.read().collect(), key=str), sorted(raw.read().collect(), key=str))
        )
    assert results[0] == results[1] == results[2]
    assert len(results[0][1]) == 150
    ids = [r["property_id"] for r in results[0][0]]
    assert len(ids) == len(set(ids)) > 0


def test_batch_job_halts_before_writing(spark, tmp_path):
    raw, cleaned, stamp = tables(spark, tmp_path)
    with pytest.raises(gates.QualityError, match="row_count > 100"):
        batch_job.load_batch(batch_rows(spark, 50), raw, cleaned, 1, stamp)
    no_url = batch_rows(spark).withColumn("source_url", F.lit(None).cast("string"))
    with pytest.raises(gates.QualityError, match="source_url complete"):
        batch_job.load_batch(no_url, raw, cleaned, 1, stamp)
    assert not raw.commits() and not cleaned.commits()
    worthless = batch_rows(spark).withColumn("price_ksh", F.lit(1))
    with pytest.raises(gates.QualityError, match="row_count > 0"):
        batch_job.load_batch(worthless, raw, cleaned, 1, stamp)
    assert len(raw.commits()) == 1 and not cleaned.commits()


def test_failed_rerun_leaves_the_committed_version(spark, tmp_path):
    raw, cleaned, stamp = tables(spark, tmp_path)
    batch_job.load_batch(batch_rows(spark), raw, cleaned, 1, stamp)
    before = sorted(raw.read().collect(), key=str), sorted(cleaned.read().collect(), key=str)
    with pytest.raises(gates.QualityError, match="row_count > 100"):
        batch_job.load_batch(batch_rows(spark, 50), raw, cleaned, 1, stamp)
    assert (sorted(raw.read().collect(), key=str), sorted(cleaned.read().collect(), key=str)) == before


def test_batch_casts_text_columns(spark, tmp_path):
    raw, cleaned, stamp = tables(spark, tmp_path)
    text = batch_rows(spark).select([F.col(c).cast("string").alias(c) for c in CANONICAL_COLUMNS])
    batch_job.load_batch(
        text.withColumn("bathrooms", F.lit("two")), raw, cleaned, 1, stamp
    )
    assert raw.read().filter("bathrooms IS NOT NULL").count() == 0
    assert cleaned.read().count() > 0


def test_suites_name_only_known_labels(spark):
    assert len(suites.batch_cleaned_rules()) == 5 and "Unknown" in config.VALUE_ZONES


def test_rules_counted_while_writing(spark, tmp_path):
    wanted = [rules.row_count_over(0), rules.complete("k"), rules.complete("z", "warn")]
    rows = table(spark, [("a", 1, None, None), (None, 2, None, None)])
    watched, report = rules.observe(rows, "t", wanted)
    watched.write.parquet(str(tmp_path / "out"))
    direct = [r.asDict() for r in rules.evaluate(rows, "t", wanted).collect()]
    assert report() == direct
    assert [r["status"] for r in direct] == ["pass", "fail", "warn"]


def test_empty_batch_halts(spark, tmp_path):
    raw, cleaned, stamp = tables(spark, tmp_path)
    for empty in (batch_rows(spark).filter("1 = 0"), batch_rows(spark).filter("price_ksh < 0")):
        with pytest.raises(gates.QualityError, match="row_count > 100"):
            batch_job.load_batch(empty, raw, cleaned, 1, stamp)
