from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rentlens.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate one column expression over given rows of one column `x`."""

    def evaluate(values, dtype, expression):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {dtype}")
        out = df.select("i", expression.alias("y")).orderBy("i").collect()
        return [r["y"] for r in out]

    return evaluate
