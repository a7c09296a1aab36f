"""Model assertions. Each returns the rows that break it, so none is a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, Settings
from rentlens.plans.marts import composite_score


def leakage(enriched: DataFrame, fact: DataFrame) -> DataFrame:
    """The fact must hold every enriched row that has a group and a day."""
    expected = enriched.dropna(subset=["neighbourhood", "scraped_date"]).agg(
        F.count("*").alias("total_expected_rows")
    )
    actual = fact.agg(F.count("*"))
    return (
        expected.withColumn("total_actual_rows", actual.scalar())
        .withColumn(
            "dropped_rows_count", F.col("total_expected_rows") - F.col("total_actual_rows")
        )
        .filter("dropped_rows_count > 0")
    )


def bedroom_averages(enriched: DataFrame) -> DataFrame:
    return (
        enriched.dropna(subset=["price_ksh", "bedroom_label"])
        .groupBy("neighbourhood", "bedroom_label")
        .agg(F.avg("price_ksh").alias("avg_rent_ksh"))
    )


def with_one_bed_price(averages: DataFrame) -> DataFrame:
    """A partition holds one row per bedroom label."""
    one_bed = F.when(F.col("bedroom_label") == "1 BR", F.col("avg_rent_ksh"))
    return averages.withColumn(
        "local_1br_avg_price", F.max(one_bed).over(Window.partitionBy("neighbourhood"))
    )


def bedroom_pricing(enriched: DataFrame) -> DataFrame:
    """Three bedrooms and more, on average over 20 % cheaper than one."""
    return with_one_bed_price(bedroom_averages(enriched)).filter(
        F.col("bedroom_label").isin("3 BR", "4+ BR")
        & (F.col("avg_rent_ksh") < F.col("local_1br_avg_price") * F.lit(0.8))
    )


def misaligned() -> Column:
    tier, segment = F.col("commute_tier"), F.col("location_segment")
    inner, middle = "Core CBD / Inner Ring", "Mid-Ring Suburb"
    return (
        (tier.isin("1 - Walking (0-2 km)", "2 - Short (2-5 km)") & (segment != inner))
        | ((tier == "3 - Medium (5-8 km)") & ~segment.isin(inner, middle))
        | ((tier == "5 - Far (15+ km)") & (segment == inner))
    )


def geographic_alignment(enriched: DataFrame) -> DataFrame:
    return enriched.filter(misaligned()).select(
        "property_id", "dist_to_archives_km", "commute_tier", "location_segment"
    )


def miscalculated() -> Column:
    priced = F.col("price_ksh").isNotNull()
    median = F.col("neighbourhood_median_ksh")
    return (
        (F.col("neighbourhood").isNotNull() & priced & median.isNull())
        | (priced & median.isNotNull() & F.col("price_vs_neighbourhood_median").isNull())
        | (median == 0)
    )


def neighbourhood_maths(enriched: DataFrame) -> DataFrame:
    return enriched.filter(miscalculated()).select(
        "property_id", "neighbourhood", "price_ksh", "neighbourhood_median_ksh",
        "price_vs_neighbourhood_median",
    )


def without_median() -> Column:
    return F.col("neighbourhood").isNotNull() & F.col("neighbourhood_median_ksh").isNull()


def orphan_medians(enriched: DataFrame) -> DataFrame:
    return enriched.filter(without_median()).select(
        "property_id", "neighbourhood", "price_ksh", "neighbourhood_median_ksh"
    )


def misdirected() -> Column:
    """The sign must follow the gap. A gap that rounds to 0.0 % has no sign."""
    price, median = F.col("price_ksh"), F.col("neighbourhood_median_ksh")
    pct = F.col("price_vs_neighbourhood_median")
    visible = F.abs(price - median) * 100.0 >= median * F.lit(0.05)
    return (
        (visible & (price > median) & (pct <= 0))
        | (visible & (price < median) & (pct >= 0))
        | ((price == median) & (pct != 0))
    )


def percentage_direction(enriched: DataFrame) -> DataFrame:
    return enriched.filter(misdirected()).select(
        "property_id", "price_ksh", "neighbourhood_median_ksh", "price_vs_neighbourhood_median"
    )


def false_bargain(s: Settings = DEFAULTS) -> Column:
    return F.col("is_sweet_spot") & (
        (F.col("price_ksh") >= s.sweet_price)
        | (F.col("dist_to_archives_km") > s.sweet_km)
        | (F.col("price_ksh") > F.col("neighbourhood_median_ksh"))
    )


def sweet_spot_rules(enriched: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    return enriched.filter(false_bargain(s)).select(
        "property_id", "price_ksh", "dist_to_archives_km", "neighbourhood_median_ksh",
        "is_sweet_spot",
    )


def rank_one_benchmarks(stats: DataFrame) -> DataFrame:
    """Each rank 1 must hold the extreme of its measure over the whole table."""
    extremes = {
        "true_min_index": F.min("affordability_index"),
        "true_max_rent": F.max("avg_rent_ksh"),
        "true_max_supply": F.max("total_listings"),
    }
    return (
        stats.withColumns({name: stats.select(agg).scalar() for name, agg in extremes.items()})
        .filter(
            ((F.col("value_rank") == 1) & (F.col("affordability_index") != F.col("true_min_index")))
            | ((F.col("price_rank") == 1) & (F.col("avg_rent_ksh") != F.col("true_max_rent")))
            | ((F.col("supply_rank") == 1) & (F.col("total_listings") != F.col("true_max_supply")))
        )
        .select(
            "neighbourhood", "value_rank", "price_rank", "supply_rank", "affordability_index",
            "avg_rent_ksh", "total_listings", *extremes,
        )
    )


def expected_score(s: Settings = DEFAULTS) -> Column:
    return composite_score(
        F.col("price_rank"), F.col("distance_rank"), F.col("consistency_rank"), s
    )


def deviates(s: Settings = DEFAULTS, tolerance: float = 0.02) -> Column:
    return F.abs(F.col("composite_score") - expected_score(s)) > tolerance


def score_deviation(
    finder: DataFrame, s: Settings = DEFAULTS, tolerance: float = 0.02
) -> DataFrame:
    return finder.filter(deviates(s, tolerance)).select(
        "neighbourhood",
        F.col("composite_score").alias("stored_score"),
        expected_score(s).alias("expected_score"),
        F.abs(F.col("composite_score") - expected_score(s)).alias("deviation"),
    )


def rank_order(finder: DataFrame) -> DataFrame:
    """Rank 1 may not score worse than rank 2. Without a rank 2 nothing is compared."""

    def score_at(rank: int):
        # All rows of a rank share one score, so the minimum is that score.
        return finder.filter(F.col("overall_value_rank") == rank).agg(F.min("composite_score"))

    return (
        score_at(1)
        .toDF("rank1_score")
        .withColumn("rank2_score", score_at(2).scalar())
        .filter("rank1_score > rank2_score")
    )


# What two of the verdicts promise.
CONTRACTS = {
    "Project Star": "sweet_spot_pct >= 60 AND dist_to_archives_km <= 8",
    "Premium Location": "dist_to_archives_km <= 5 AND median_rent_ksh >= 50000",
}


def breaks_contract() -> Column:
    broken = F.lit(False)
    for verdict, contract in CONTRACTS.items():
        broken = broken | ((F.col("verdict") == verdict) & ~F.expr(f"({contract})"))
    return broken


def verdict_contract(finder: DataFrame) -> DataFrame:
    reason = F.concat(F.col("verdict"), F.lit(" criteria violated")).alias("failure_reason")
    return finder.filter(breaks_contract()).select(
        "neighbourhood", "verdict", "sweet_spot_pct", "dist_to_archives_km", reason
    )
