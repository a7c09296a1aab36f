"""Enriched listings: each listing against its neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, Settings
from rentlens.functions import classify, numeric
from rentlens.operators.percentiles import grouped_median
from rentlens.operators.spool import spool


def neighbourhood_medians(staged: DataFrame) -> DataFrame:
    return grouped_median(
        staged.dropna(subset=["neighbourhood", "price_ksh"]),
        ["neighbourhood"],
        "price_ksh",
        "neighbourhood_median_ksh",
    )


def enriched_listings(staged: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """`staged` is read twice, so pass a stored table or a spooled frame.

    The medians are spooled so the planner sees their true size: below the
    broadcast threshold the listings are not shuffled at all, above it they are
    sort-merge joined and a hot neighbourhood is split at run time.
    """
    base = staged.filter(F.col("price_ksh").isNotNull())
    medians = spool(neighbourhood_medians(base))
    price, km = F.col("price_ksh"), F.col("dist_to_archives_km")
    bedrooms, median = F.col("bedrooms"), F.col("neighbourhood_median_ksh")
    return base.join(medians, "neighbourhood", "left").select(
        *[F.col(c) for c in staged.columns],
        "neighbourhood_median_ksh",
        classify.commute_tier(km).alias("commute_tier"),
        classify.location_segment(km).alias("location_segment"),
        classify.is_sweet_spot(F.col("value_zone"), bedrooms, price, median, s).alias(
            "is_sweet_spot"
        ),
        classify.bedroom_label(bedrooms).alias("bedroom_label"),
        numeric.pct_of(price, median).alias("price_vs_neighbourhood_median"),
    )
