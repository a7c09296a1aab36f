"""Schemas of the raw and canonical listing, so no job ever infers one."""

from __future__ import annotations

from pyspark.sql import types as T

# What a card or an upload may carry: every field text, any of them absent.
RAW_RECORD = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in [
            "id", "propertyId", "title", "name", "description",
            "price", "rentPrice", "location", "suburb", "area",
            "url", "link", "propertyType", "type",
            "bedrooms", "beds", "bathrooms", "baths",
        ]
    ]
)

CANONICAL = T.StructType(
    [
        T.StructField("property_id", T.StringType()),
        T.StructField("scraped_at", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("location_raw", T.StringType()),
        T.StructField("neighbourhood", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("dist_to_archives_km", T.DoubleType()),
        T.StructField("price_raw", T.StringType()),
        T.StructField("price_ksh", T.IntegerType()),
        T.StructField("bedrooms", T.IntegerType()),
        T.StructField("bathrooms", T.IntegerType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
    ]
)
CANONICAL_COLUMNS = CANONICAL.fieldNames()

# The landed table: the canonical record and its arrival stamp (no zone).
LANDED = T.StructType(
    CANONICAL.fields + [T.StructField("firehose_arrival_at", T.TimestampNTZType())]
)

NUMERIC_CASTS = {
    "latitude": "double",
    "longitude": "double",
    "dist_to_archives_km": "double",
    "price_ksh": "int",
    "bedrooms": "int",
    "bathrooms": "int",
}

ENVELOPE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("seq", T.StringType()),
        T.StructField("arrival", T.DoubleType()),
    ]
)

LOOKUP = T.StructType(
    [
        T.StructField("raw_string", T.StringType()),
        T.StructField("matched_name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)
