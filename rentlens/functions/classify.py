"""Classifiers: first matching arm wins, so arm order is part of the meaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, Settings


def value_zone(price: Column, distance: Column, s: Settings = DEFAULTS) -> Column:
    """Needs the unrounded distance; 5.004 km is not within 5 km."""
    return F.when(price.isNull(), "Unknown").otherwise(batch_value_zone(price, distance, s))


def batch_value_zone(price: Column, distance: Column, s: Settings = DEFAULTS) -> Column:
    """The batch variant, whose input has no null prices."""
    return (
        F.when(distance.isNull(), "Unknown")
        .when((price >= s.premium_price) & (distance <= s.premium_km), "Premium")
        .when((price < s.sweet_price) & (distance <= s.sweet_km), "Sweet Spot")
        .when(distance > s.commuter_km, "Commuter")
        .otherwise("Mid-range")
    )


def price_bucket(price: Column) -> Column:
    return (
        F.when(price < 15_000, "Under 15k")
        .when(price.between(15_000, 29_999), "15k - 30k")
        .when(price.between(30_000, 49_999), "30k - 50k")
        .when(price.between(50_000, 79_999), "50k - 80k")
        .when(price >= 80_000, "80k+")
        .otherwise("Unknown")
    )


def commute_tier(distance: Column) -> Column:
    return (
        F.when(distance <= 2.0, "1 - Walking (0-2 km)")
        .when(distance <= 5.0, "2 - Short (2-5 km)")
        .when(distance <= 8.0, "3 - Medium (5-8 km)")
        .when(distance <= 15.0, "4 - Long (8-15 km)")
        .when(distance > 15.0, "5 - Far (15+ km)")
        .otherwise("Unknown")
    )


def location_segment(distance: Column) -> Column:
    """A missing distance counts as the outermost ring."""
    return (
        F.when(distance <= 5.0, "Core CBD / Inner Ring")
        .when(distance <= 10.0, "Mid-Ring Suburb")
        .when(distance <= 15.0, "Commuter Zone")
        .otherwise("Satellite Town")
    )


def is_sweet_spot(
    zone: Column, bedrooms: Column, price: Column, median: Column, s: Settings = DEFAULTS
) -> Column:
    livable = (bedrooms >= 1) | ((bedrooms == 0) & (price < s.studio_price))
    return F.coalesce((zone == "Sweet Spot") & livable & (price <= median), F.lit(False))


def bedroom_label(bedrooms: Column) -> Column:
    return (
        F.when(bedrooms == 0, "Studio")
        .when(bedrooms == 1, "1 BR")
        .when(bedrooms == 2, "2 BR")
        .when(bedrooms == 3, "3 BR")
        .when(bedrooms >= 4, "4+ BR")
        .otherwise("Unknown")
    )


def data_confidence(count: Column, s: Settings = DEFAULTS) -> Column:
    return (
        F.when(count >= s.robust_count, "High (Robust)")
        .when(count >= s.stable_count, "Medium (Stable)")
        .otherwise("Low (Volatile/Small Sample)")
    )


def verdict(sweet_pct: Column, distance: Column, median: Column) -> Column:
    return (
        F.when((sweet_pct >= 60) & (distance <= 8), "Project Star")
        .when((distance <= 5) & (median >= 50_000), "Premium Location")
        .when((distance <= 8) & (median < 40_000), "Good Value")
        .when((distance > 12) & (median < 20_000), "Budget Commuter")
        .otherwise("Average")
    )


def max_label(label: Column, labels: Sequence[str]) -> Column:
    """Alphabetical maximum over a closed set of labels, as an aggregate.

    It compares positions: a maximum of text would make Spark sort all rows
    instead of hashing them.
    """
    ordered = F.array(*[F.lit(v) for v in sorted(labels)])
    return F.get(ordered, F.max(F.array_position(ordered, label)).cast("int") - 1)
