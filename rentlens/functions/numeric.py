"""Rounding and ratios. Doubles pass through a decimal before rounding,
so that 1.005 rounds to 1.01 on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def km(col: Column) -> Column:
    """Kilometres with two decimals; null beyond what they can hold."""
    return F.round(col.try_cast("decimal(12,6)").cast("decimal(10,2)"), 2)


def round_to(col: Column, digits: int) -> Column:
    return F.round(col.try_cast("decimal(28,8)"), digits).try_cast(f"decimal(18,{digits})")


def pct_of(value: Column, base: Column) -> Column:
    """Change of value against base in percent, one decimal; null unless base > 0."""
    return F.when(base > 0, round_to((value - base) * F.lit(100.0) / base, 1))


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage with one decimal; null when the whole is 0."""
    return round_to(F.try_divide(F.lit(100.0) * part, whole), 1)


def affordability(avg_price: Column, distance: Column) -> Column:
    """Average rent in thousands per kilometre; null unless the distance is > 0."""
    return F.when(
        distance > 0, round_to(avg_price / F.lit(1000.0) / distance.cast("double"), 2)
    )


def within_or_null(col: Column, low: int, high: int) -> Column:
    return F.when(col.between(low, high), col)
