"""Text cleaning, first-non-empty and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def trimmed_or(col: Column, default: str) -> Column:
    """Blank text becomes `default`. Only spaces are trimmed."""
    return F.coalesce(blank_to_null(F.trim(col)), F.lit(default))


def proper_case(col: Column) -> Column:
    return F.initcap(F.trim(col))


def first_non_empty(*cols: Column, default: str | None = None) -> Column:
    """First value that is neither null nor ''. Zero counts as a value."""
    candidates = [blank_to_null(c) for c in cols]
    if default is not None:
        candidates.append(F.lit(default))
    return F.coalesce(*candidates)


def first_part(col: Column, separator: str) -> Column:
    return F.split_part(col, F.lit(separator), F.lit(1))


def key_safe(col: Column) -> Column:
    return F.translate(col, ":", "-")


def tooltip(place: Column, bedrooms: Column, price: Column) -> Column:
    """'place - bedrooms (price KSh)'; null when any part is null."""
    return F.concat(
        place, F.lit(" - "), bedrooms, F.lit(" ("), price.cast("string"), F.lit(" KSh)")
    )
