"""The transport envelope: base64 of UTF-8 JSON, with delivery metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.functions.text import first_part
from rentlens.schema import CANONICAL

METADATA = ["_shard", "_seq", "_arrival"]


class AllRecordsFailed(RuntimeError):
    """No record of a batch could be decoded, so the batch must be retried."""


def wrap(
    df: DataFrame, payload: Column, event_id: Column, seq: Column, arrival: Column
) -> DataFrame:
    return df.select(
        event_id.alias("event_id"),
        F.base64(payload.cast("binary")).alias("data"),
        seq.alias("seq"),
        arrival.alias("arrival"),
    )


def decode(envelopes: DataFrame, schema: T.StructType = CANONICAL) -> DataFrame:
    """Adds `record`, null where the payload is no base64, UTF-8 or JSON object.

    Fields are read as text and then cast, so one field of the wrong type is a
    null in its row and not a lost record.
    """
    return with_record(envelopes, plain_text(F.col("data")), schema)


def plain_text(encoded: Column) -> Column:
    """The text that base64 stands for; null where it stands for none."""
    return F.try_validate_utf8(F.try_to_binary(encoded, F.lit("base64")).try_cast("string"))


def with_record(df: DataFrame, text: Column, schema: T.StructType = CANONICAL) -> DataFrame:
    """Adds `record`, the JSON object in `text`; null where it is none."""
    as_text = T.StructType(
        [T.StructField(c, T.StringType()) for c in [*schema.fieldNames(), "_corrupt"]]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    typed = F.struct(
        *[F.col(f"_parsed.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    decodable = F.col("_parsed").isNotNull() & F.col("_parsed._corrupt").isNull()
    # Exploding one element keeps the planner from parsing the text anew for each use.
    return (
        df.withColumn("_parsed", F.explode(F.array(F.from_json(text, as_text, options))))
        .withColumn("record", F.when(decodable, typed))
        .drop("_parsed")
    )


def valid_rows(decoded: DataFrame) -> DataFrame:
    """Payload columns and the delivery metadata of decodable records."""
    return decoded.filter(F.col("record").isNotNull()).select(
        "record.*",
        first_part(F.col("event_id"), ":").alias("_shard"),
        F.col("seq").alias("_seq"),
        F.col("arrival").alias("_arrival"),
    )


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("record").isNull()).select("event_id", "data", "seq", "arrival")


def delivery_counts(decoded: DataFrame) -> DataFrame:
    return decoded.agg(
        F.count_if(F.col("record").isNotNull()).alias("records_ok"),
        F.count_if(F.col("record").isNull()).alias("records_error"),
    )


def require_some_valid(ok: int, errors: int) -> None:
    if ok == 0 and errors > 0:
        raise AllRecordsFailed(f"none of {errors} records could be decoded")
