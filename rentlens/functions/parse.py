"""Parsers from scraped text to typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentlens.functions.text import blank_to_null

# The patterns results depend on.
PRICE_PATTERN = r"(\d+(\.\d+)?)"
PRICE_WITH_SUFFIX = r"(?i)(\d+(?:\.\d+)?)(k\b)?"
BEDROOM_PATTERN = r"(\d+)\s*(?:bed|bd|bedroom)"
NUMBER_PATTERN = r"(\d+)"


def price(raw: Column, k_suffix: bool = False) -> Column:
    """First number in the text, thousands commas removed, fraction cut off.

    '30k' reads as 30 unless `k_suffix` asks for 30000.
    """
    text = F.replace(raw, F.lit(","), F.lit(""))
    if k_suffix:
        number = F.regexp_extract(text, PRICE_WITH_SUFFIX, 1)
        scale = F.when(F.regexp_extract(text, PRICE_WITH_SUFFIX, 2) != "", 1000).otherwise(1)
    else:
        number = F.regexp_extract(text, PRICE_PATTERN, 1)
        scale = F.lit(1)
    value = F.floor(blank_to_null(number).try_cast("double") * scale)
    return value.try_cast("int")


def bedrooms(title: Column, description: Column) -> Column:
    """0 for a studio, otherwise the number before bed, bd or bedroom."""
    text = F.lower(
        F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")))
    )
    count = blank_to_null(F.regexp_extract(text, BEDROOM_PATTERN, 1)).try_cast("int")
    return F.when(F.contains(text, F.lit("studio")), F.lit(0)).otherwise(count)


def whole_number(col: Column) -> Column:
    return blank_to_null(F.regexp_extract(col, NUMBER_PATTERN, 1)).try_cast("int")


def stable_id(url: Column, prefix: str) -> Column:
    """Prefix and 12 hex digits of the url's MD5; null when there is no url."""
    return F.concat(F.lit(prefix), F.substring(F.md5(blank_to_null(url)), 1, 12))
