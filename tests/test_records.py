from __future__ import annotations

import base64
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.functions.convert import EXACT
from rentlens.sources import records

TEXTS = [
    '{"id": 1, "b": 1.50, "a": {"x": [1.0, 2.25], "n": null}, "s": "t", "e": 1e-3}',
    '{"id": 2, "b": 10, "we ird": 0.1, "OBJECT<": {"VOID": 0.30}, "a": {"x": []}, "mixed": 1.5}',
    '{"id": 3, "mixed": "text", "e": 1e30}',
    "[1, 2]", "{bad", '{"a": 1, "a": 2}', "3", None, "{}", "",
]


def read(spark, texts=TEXTS):
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, sent string")
    return records.with_record(rows, F.col("sent"))


def test_every_field_is_kept_and_numbers_are_exact(spark):
    got = {r["n"]: r["kept"] for r in read(spark).select("n", records.stored_text().alias("kept")).collect()}
    assert got[0] == '{"a":{"n":null,"x":[1,2.25]},"b":1.5,"e":0.001,"id":1,"s":"t"}'
    assert got[1] == '{"OBJECT<":{"VOID":0.3},"a":{"x":[]},"b":10,"id":2,"mixed":1.5,"we ird":0.1}'
    assert got[8] == "{}" and [got[n] for n in (3, 4, 5, 6, 7, 9)] == [None] * 6


def test_columns_from_the_records_themselves(spark):
    df = read(spark)
    dtype = records.record_type(df)
    assert dtype["e"].dataType == EXACT and isinstance(dtype["b"].dataType, T.DecimalType)
    assert isinstance(dtype["mixed"].dataType, T.VariantType)
    assert dtype["a"].dataType["n"].dataType == T.StringType()
    got = {r["n"]: r["record"] for r in records.typed(df).collect()}
    assert got[0]["b"] == Decimal("1.5") and got[0]["a"]["x"] == [Decimal(1), Decimal("2.25")]
    assert got[0]["e"] == Decimal("0.001") and got[1]["we ird"] == Decimal("0.1")
    assert got[1]["OBJECT<"]["VOID"] == Decimal("0.3") and got[1]["b"] == 10
    # A number beyond its column is null, and no field beside it.
    assert got[2]["e"] is None and got[2]["id"] == 3
    assert got[3] is None and got[7] is None


def test_no_records(spark):
    for texts in ([], [None, "[]"], ["{}"]):
        df = read(spark, texts) if texts else read(spark).filter("false")
        assert records.record_type(df) == T.StructType([])


def test_unknown_fields_pass_through_an_envelope(spark):
    sent = base64.b64encode('{"property_id": "p", "new": {"deep": [0.10, {"x": 7.0}]}}'.encode()).decode()
    rows = spark.createDataFrame([("e1", sent), ("e2", "###"), ("e3", None)], "event_id string, data string")
    got = {r["event_id"]: r["t"] for r in records.decode(rows).select("event_id", records.stored_text().alias("t")).collect()}
    assert got == {"e1": '{"new":{"deep":[0.1,{"x":7}]},"property_id":"p"}', "e2": None, "e3": None}
