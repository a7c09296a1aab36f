"""Exact decimals for stored records, and JSON in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT = T.DecimalType(38, 18)


def exact_type(dtype: T.DataType) -> T.DataType:
    """The same type with every float, however deeply nested, an exact decimal; what was
    never anything but null is text."""
    if isinstance(dtype, T.NullType):
        return T.StringType()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return EXACT
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(exact_type(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, exact_type(dtype.valueType), dtype.valueContainsNull)
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [T.StructField(f.name, exact_type(f.dataType), f.nullable) for f in dtype.fields]
        )
    return dtype


def floats_to_exact(df: DataFrame) -> DataFrame:
    return df.select(
        [F.col(f.name).cast(exact_type(f.dataType)).alias(f.name) for f in df.schema.fields]
    )


def record_json(*cols: str) -> Column:
    """One JSON text per row. Null fields are left out."""
    return F.to_json(F.struct(*cols))
