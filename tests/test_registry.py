"""A part of the registered queries against their SQL; check.py runs them all."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check import rows_of

SMALL = "/root/testdata/sf0.001"
CHECKED = [
    "q1_staging", "q2_enriched", "q3_date_dimension", "q5_listings_fact",
    "q6_neighbourhood_stats", "q7_value_ranking", "q8_rent_trends", "q9_price_points",
    "q10_batch_job", "q11_canonical_from_cards", "q12_stream_to_staging", "q13_quality_report",
    "j8_fuzzy_by_edits", "j10_resolution_cascade", "w3_rank_over_ranges", "f14_geodesic_km",
    "s6_history_upsert", "s12_listing_cards", "u3_reconciled_tables",
]


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
