"""Staging: gate, latest delivery per listing, clean, classify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, Settings
from rentlens.functions import classify, dates, numeric, text
from rentlens.operators.dedupe import latest_per_key
from rentlens.operators.filters import quality_gate

STREAM_STAMPS = ["firehose_arrival_at", "ingested_at", "scraped_at"]
BATCH_STAMPS = ["ingested_at", "scraped_at"]

# The columns of the cleaned table, in its order.
CLEANED = [
    "property_id", "scraped_at_eat", "scraped_date", "source_url", "location_raw",
    "neighbourhood", "latitude", "longitude", "dist_to_archives_km", "value_zone",
    "price_raw", "price_ksh", "price_bucket", "bedrooms", "bathrooms",
    "property_type", "title",
]


def staged_listings(
    raw: DataFrame, s: Settings = DEFAULTS, delivery: str | None = None
) -> DataFrame:
    """One clean row per listing, from the landed table. `delivery` names a column that
    numbers the deliveries of a listing without repeats, if the source has one."""
    return cleaned_rows(_latest(quality_gate(raw, s), STREAM_STAMPS, delivery), s)


def cleaned_rows(rows: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Landed rows with clean values and classes, none dropped."""
    zone = classify.value_zone(F.col("price_ksh"), F.col("dist_to_archives_km"), s)
    return rows.select(*_clean(zone, s), "firehose_arrival_at", "ingested_at")


def batch_cleaned(
    raw: DataFrame, cleaned_at: Column | None = None, s: Settings = DEFAULTS,
    delivery: str | None = None,
) -> DataFrame:
    """The batch variant: ordered by the ingestion stamp, no arrival column."""
    latest = _latest(quality_gate(raw, s), BATCH_STAMPS, delivery)
    zone = classify.batch_value_zone(F.col("price_ksh"), F.col("dist_to_archives_km"), s)
    stamp = cleaned_at if cleaned_at is not None else dates.now_utc()
    return latest.select(*_clean(zone, s), "ingested_at", stamp.alias("batch_cleaned_at"))


def _latest(rows: DataFrame, stamps: list[str], delivery: str | None) -> DataFrame:
    if delivery is not None:
        return latest_per_key(rows, ["property_id"], [stamps[0], delivery], True)
    return latest_per_key(rows, ["property_id"], stamps)


def _clean(zone: Column, s: Settings) -> list[Column]:
    """Zone and bucket read the distance as delivered, before it is rounded."""
    observed = dates.utc_timestamp(F.col("scraped_at"))
    cleaned = {
        "scraped_at_eat": dates.to_zone(observed, s.local_zone),
        "scraped_date": observed.cast("date"),
        "location_raw": F.trim("location_raw"),
        "neighbourhood": text.proper_case(F.col("neighbourhood")),
        "dist_to_archives_km": numeric.km(F.col("dist_to_archives_km")),
        "value_zone": zone,
        "price_bucket": classify.price_bucket(F.col("price_ksh")),
        "bedrooms": numeric.within_or_null(F.col("bedrooms"), 0, s.max_bedrooms),
        "bathrooms": numeric.within_or_null(F.col("bathrooms"), 0, s.max_bathrooms),
        "property_type": text.trimmed_or(F.col("property_type"), "Unknown"),
        "title": text.trimmed_or(F.col("title"), "No title"),
    }
    return [cleaned.get(c, F.col(c)).alias(c) for c in CLEANED]
