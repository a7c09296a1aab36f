"""The batch cleaning job: check, load raw, clean, check, load cleaned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, Settings
from rentlens.operators.dedupe import merge_latest
from rentlens.operators.filters import cast_columns
from rentlens.operators.upsert import KeyedTable
from rentlens.plans.staging import batch_cleaned
from rentlens.quality import rules, suites
from rentlens.quality.gates import halt_on_failure
from rentlens.schema import CANONICAL_COLUMNS


def load_batch(
    source: DataFrame,
    raw_table: KeyedTable,
    cleaned_table: KeyedTable,
    version: int,
    cleaned_at: Column | None = None,
    min_rows: int = 100,
    s: Settings = DEFAULTS,
) -> None:
    """A version becomes visible only when its rules hold: a bad source leaves both
    tables as they are, a bad result the cleaned one, also when the version was loaded
    before. Running a version again replaces its rows.

    The source is read once and each table written once. Rules are counted while
    writing, and cleaning reads back the typed columns just written.
    """
    typed, source_report = rules.observe(
        cast_columns(source).select(CANONICAL_COLUMNS),
        "source",
        suites.batch_source_rules(min_rows),
    )
    attempt = raw_table.stage(typed)
    halt_on_failure(source_report(), "source")
    raw_table.commit(attempt, version)

    cleaned, cleaned_report = rules.observe(
        batch_cleaned(raw_table.staged(attempt), cleaned_at, s),
        "cleaned",
        suites.batch_cleaned_rules(s),
    )
    attempt = cleaned_table.stage(cleaned)
    halt_on_failure(cleaned_report(), "cleaned")
    cleaned_table.commit(attempt, version)


def reconciled(streamed: DataFrame, batch: DataFrame) -> DataFrame:
    """Stream and batch tables as one: the newest ingestion of a listing wins."""
    return merge_latest(
        streamed.select(CANONICAL_COLUMNS).withColumn("origin", F.lit("stream")),
        batch.select(CANONICAL_COLUMNS).withColumn("origin", F.lit("batch")),
        ["property_id"],
        ["ingested_at", "scraped_at"],
    )
