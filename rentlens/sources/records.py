"""Records of any shape: JSON objects whose fields are not known beforehand.

A record is held as a variant: no field is lost, a number written with a point is an exact
decimal without trailing zeros, and nothing is parsed twice. Where columns are wanted, one
aggregate finds the type that holds every record, and the records are cast to it.

Defined results: null, text that is no JSON, JSON that is no object, and objects that name
a field twice have no record. Numbers of more than 38 digits or with an exponent are
doubles in the variant. A field that is a number here and text there stays a variant. The
type grows with the different field names, not with the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.functions.convert import exact_type
from rentlens.sources.envelope import plain_text


def with_record(df: DataFrame, text: Column, name: str = "record") -> DataFrame:
    """Adds the JSON object in `text` as a variant."""
    parsed = df.withColumn(name, F.try_parse_json(text))
    is_object = F.schema_of_variant(name).startswith("OBJECT<")
    return parsed.withColumn(name, F.when(is_object, F.col(name)))


def decode(envelopes: DataFrame) -> DataFrame:
    """Adds `record`, whatever fields the payload of an envelope has."""
    return with_record(envelopes, plain_text(F.col("data")))


def record_type(df: DataFrame, name: str = "record") -> T.StructType:
    """The type that holds every record, floats as decimals; one pass over `df`."""
    found = df.agg(F.schema_of_variant_agg(name)).first()[0]
    if not found.startswith("OBJECT<"):
        return T.StructType([])
    return exact_type(T.DataType.fromDDL(_as_structs(found)))


def _as_structs(ddl: str) -> str:
    """The type in words that a schema has. Names between backquotes stay as they are."""
    parts = ddl.split("`")
    return "`".join(p if i % 2 else p.replace("OBJECT<", "STRUCT<") for i, p in enumerate(parts))


def typed(df: DataFrame, name: str = "record", dtype: T.StructType | None = None) -> DataFrame:
    """`df` with its variant as a struct. A stream, which cannot be looked through, needs
    `dtype`; fields that it does not name are left out."""
    dtype = record_type(df, name) if dtype is None else dtype
    return df.withColumn(name, F.col(name).try_cast(dtype))


def stored_text(name: str = "record") -> Column:
    """JSON with all fields of the record in order of their names, numbers exact."""
    return F.to_json(name)
