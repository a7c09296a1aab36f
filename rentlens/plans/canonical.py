"""Raw record to canonical listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, Settings
from rentlens.functions import parse
from rentlens.functions.dates import now_utc
from rentlens.functions.text import first_non_empty
from rentlens.operators.profile import run_summary
from rentlens.operators.resolve import distinct_texts, new_cache_rows, resolve_texts, with_place
from rentlens.operators.spool import spool
from rentlens.schema import CANONICAL_COLUMNS, RAW_RECORD
from rentlens.sources.tables import append_lookup


def iso_utc(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def raw_columns(df: DataFrame) -> DataFrame:
    """Give a raw frame every alternative key, absent ones as null."""
    present = set(df.columns)
    missing = {f: F.lit(None).cast("string") for f in RAW_RECORD.fieldNames() if f not in present}
    if "card_bathrooms" not in present:
        missing["card_bathrooms"] = F.lit(None).cast("int")
    return df.withColumns(missing)


def parsed(raw: DataFrame, stamp: Column | None = None, s: Settings = DEFAULTS) -> DataFrame:
    """Everything but the place. Records with neither id nor url get no id and
    fall at the required-field check, so they cannot collapse into one listing."""
    r = raw_columns(raw)
    price_text = first_non_empty(F.col("price"), F.col("rentPrice"), default="")
    return r.select(
        first_non_empty(
            F.col("id"), F.col("propertyId"), parse.stable_id(F.col("url"), s.id_prefix)
        ).alias("property_id"),
        iso_utc(stamp if stamp is not None else now_utc()).alias("scraped_at"),
        first_non_empty(F.col("url"), F.col("link"), default="").alias("source_url"),
        first_non_empty(F.col("title"), F.col("name"), default="Unnamed Property").alias("title"),
        first_non_empty(F.col("location"), F.col("suburb"), F.col("area"), default="").alias(
            "location_raw"
        ),
        price_text.alias("price_raw"),
        parse.price(price_text).alias("price_ksh"),
        F.coalesce(
            parse.bedrooms(F.col("title"), F.col("description")),
            first_non_empty(F.col("bedrooms"), F.col("beds")).try_cast("int"),
        ).alias("bedrooms"),
        F.coalesce(
            F.col("card_bathrooms"),
            first_non_empty(F.col("bathrooms"), F.col("baths")).try_cast("int"),
        ).alias("bathrooms"),
        first_non_empty(F.col("propertyType"), F.col("type"), default="Apartment").alias(
            "property_type"
        ),
    )


def canonical_listings(
    raw: DataFrame,
    cache: DataFrame,
    lookup: DataFrame,
    stamp: Column | None = None,
    s: Settings = DEFAULTS,
    cache_path: str | None = None,
) -> DataFrame:
    """Records with a location, parsed and resolved. With `cache_path`, what was learned is
    appended to the cache there, so that a later run does not resolve it again.

    Parsing may have read HTML in Python, so its rows are written once: the texts
    to resolve and the join back both read that copy. The resolved texts are
    spooled too: while few, they are broadcast, and no listing is shuffled.
    """
    rows = spool(parsed(raw, stamp, s).filter(F.col("location_raw") != ""))
    resolved = spool(resolve_texts(distinct_texts(rows), cache, lookup, s))
    if cache_path is not None:
        append_lookup(new_cache_rows(resolved), cache_path)
    columns = [c for c in CANONICAL_COLUMNS if c != "ingested_at"]
    return with_place(rows, resolved, s).select(columns)


def first_records(raw: DataFrame, order: str, max_items: int) -> DataFrame:
    """The job's cap on records per run, over a stable order."""
    return raw.orderBy(order).limit(max_items)


def ingest_summary(raw: DataFrame) -> DataFrame:
    rows = parsed(raw)
    return run_summary(
        rows, skipped=F.col("location_raw") == "", failed=F.col("property_id").isNull()
    )
