"""Marts: neighbourhood statistics, value ranking, rent trends, price points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.config import COMMUTE_TIERS, DEFAULTS, VALUE_ZONES, Settings
from rentlens.functions import classify, dates, numeric, text
from rentlens.operators.filters import chartable, supported
from rentlens.operators.percentiles import grouped_percentiles
from rentlens.operators.ranking import RankBy, with_ranks

STATS_RANKS = [
    RankBy("value_rank", "affordability_index"),
    RankBy("price_rank", "avg_rent_ksh", descending=True),
    RankBy("supply_rank", "total_listings", descending=True),
]
FINDER_RANKS = [
    RankBy("price_rank", "median_rent_ksh"),
    RankBy("distance_rank", "dist_to_archives_km"),
    RankBy("consistency_rank", "iqr_rent_ksh"),
    RankBy("supply_rank", "total_listings", descending=True),
]


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def neighbourhood_stats(
    enriched: DataFrame, asof: Column | None = None, s: Settings = DEFAULTS
) -> DataFrame:
    """The statistics in their order, for output; other models read `stats_rows`."""
    return stats_rows(enriched, asof, s).orderBy(F.col("affordability_index").asc_nulls_last())


def stats_rows(
    enriched: DataFrame, asof: Column | None = None, s: Settings = DEFAULTS
) -> DataFrame:
    """One row per neighbourhood with three rankings, in no order.

    Two aggregates over the same listings, both with partial sums before their
    shuffle and both keyed on the neighbourhood, so joining them adds no shuffle.
    """
    base = enriched.dropna(subset=["neighbourhood"])
    one_bed = F.col("bedrooms") == 1
    spread = grouped_percentiles(
        base,
        ["neighbourhood"],
        F.col("price_ksh"),
        {"p25": 0.25, "p50": 0.5, "p75": 0.75},
        subset=one_bed,
        subset_points={"p50_1br": 0.5},
    ).select(
        "neighbourhood",
        F.round("p50").alias("median_rent_ksh"),
        F.round("p25").alias("p25_rent_ksh"),
        F.round("p75").alias("p75_rent_ksh"),
        (F.round("p75") - F.round("p25")).alias("iqr_rent_ksh"),
        F.round("p50_1br").alias("median_1br_rent_ksh"),
    )
    price = F.col("price_ksh")
    general = base.groupBy("neighbourhood").agg(
        F.max("latitude").alias("latitude"),
        F.max("longitude").alias("longitude"),
        F.max("dist_to_archives_km").alias("dist_to_archives_km"),
        classify.max_label(F.col("commute_tier"), COMMUTE_TIERS).alias("commute_tier"),
        classify.max_label(F.col("value_zone"), VALUE_ZONES).alias("value_zone"),
        F.round(F.avg(price)).alias("avg_rent_ksh"),
        F.min(price).alias("min_rent_ksh"),
        F.max(price).alias("max_rent_ksh"),
        F.round(F.avg(F.when(one_bed, price))).alias("avg_1br_rent_ksh"),
        F.count("*").alias("total_listings"),
        count_where(F.col("bedrooms") == 0).alias("studio_count"),
        count_where(one_bed).alias("listings_1br"),
        count_where(F.col("bedrooms") == 2).alias("listings_2br"),
        count_where(F.col("bedrooms") == 3).alias("listings_3br"),
        count_where(F.col("is_sweet_spot")).alias("sweet_spot_count"),
        numeric.affordability(F.avg(price), F.max("dist_to_archives_km")).alias(
            "affordability_index"
        ),
        numeric.share_pct(count_where(F.col("is_sweet_spot")), F.count("*")).alias(
            "sweet_spot_pct"
        ),
        F.min("scraped_date").alias("first_seen"),
        F.max("scraped_date").alias("last_seen"),
        F.count_distinct("scraped_date").alias("days_observed"),
    )
    stats = general.join(spread, "neighbourhood").withColumn(
        "updated_at", asof if asof is not None else dates.now_utc()
    )
    return with_ranks(stats, STATS_RANKS)


def composite_score(price: Column, distance: Column, consistency: Column, s: Settings) -> Column:
    return numeric.round_to(
        F.lit(s.weight_price) * price
        + F.lit(s.weight_distance) * distance
        + F.lit(s.weight_consistency) * consistency,
        2,
    )


def value_ranking(stats: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """The ranking in its order, for output; other models read `finder_rows`."""
    return finder_rows(stats, s).orderBy("overall_value_rank")


def finder_rows(stats: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Neighbourhoods with enough listings, scored, ranked and labelled."""
    qualified = supported(stats, s).select(
        "neighbourhood", "value_zone", "commute_tier", "dist_to_archives_km", "latitude",
        "longitude", "avg_rent_ksh", "median_rent_ksh", "avg_1br_rent_ksh",
        "median_1br_rent_ksh", "total_listings", "listings_1br", "sweet_spot_count",
        "sweet_spot_pct", "affordability_index", "iqr_rent_ksh", "first_seen", "last_seen",
        "updated_at",
    )
    ranked = with_ranks(qualified, FINDER_RANKS)
    scored = ranked.withColumn(
        "composite_score",
        composite_score(
            F.col("price_rank"), F.col("distance_rank"), F.col("consistency_rank"), s
        ),
    )
    overall = with_ranks(scored, [RankBy("overall_value_rank", "composite_score")])
    return overall.withColumn(
        "verdict",
        classify.verdict(
            F.col("sweet_spot_pct"), F.col("dist_to_archives_km"), F.col("median_rent_ksh")
        ),
    )


def monthly_metrics(fact: DataFrame, calendar: DataFrame, places: DataFrame) -> DataFrame:
    """Listings by neighbourhood and month.

    The month and the neighbourhood's labels follow from the key, so the fact is
    reduced first and the labels are joined to the few resulting rows.
    """
    price = F.col("price_ksh")
    keys = ["neighbourhood", "month_start"]
    dated = fact.join(
        calendar.select("date_day", "month_start"), fact["scraped_date"] == F.col("date_day")
    )
    counts = dated.groupBy(*keys).agg(
        F.count("*").alias("listing_count"),
        F.round(F.avg(price.cast("double"))).alias("avg_rent_ksh"),
        F.min(price).alias("min_rent_ksh"),
        F.max(price).alias("max_rent_ksh"),
        F.round(F.avg(F.when(F.col("bedrooms") == 1, price.cast("double")))).alias(
            "avg_1br_rent_ksh"
        ),
        count_where(F.col("is_sweet_spot")).alias("sweet_spot_count"),
    )
    medians = grouped_percentiles(dated, keys, price, {"p50": 0.5}).select(
        *keys, F.round("p50").alias("median_rent_ksh")
    )
    months = calendar.select("month_start", "month_year", "month_name", "year").distinct()
    labels = places.select("neighbourhood", "value_zone", "commute_tier")
    return (
        counts.join(medians, keys)
        .join(labels, "neighbourhood")
        .join(months, "month_start")
        .select(
            "month_start", "month_year", "month_name", "year", "neighbourhood", "value_zone",
            "commute_tier", "listing_count", "avg_rent_ksh", "median_rent_ksh",
            "min_rent_ksh", "max_rent_ksh", "avg_1br_rent_ksh", "sweet_spot_count",
        )
    )


def by_month() -> Window:
    """One row per month of a neighbourhood, so a partition holds few rows."""
    return Window.partitionBy("neighbourhood").orderBy("month_start")


def rent_trends(
    fact: DataFrame, calendar: DataFrame, places: DataFrame, s: Settings = DEFAULTS
) -> DataFrame:
    """Change against the previous month that has listings, in order, for output."""
    return trend_rows(fact, calendar, places, s).orderBy("neighbourhood", "month_start")


def trend_rows(
    fact: DataFrame, calendar: DataFrame, places: DataFrame, s: Settings = DEFAULTS
) -> DataFrame:
    return with_changes(monthly_metrics(fact, calendar, places), s)


def with_changes(monthly: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    median, previous = F.col("median_rent_ksh"), F.col("prev_month_median")
    return monthly.withColumns(
        {
            "prev_month_median": F.lag("median_rent_ksh").over(by_month()),
            "prev_month_count": F.lag("listing_count").over(by_month()),
        }
    ).withColumns(
        {
            "mom_rent_change_ksh": median - previous,
            "mom_rent_change_pct": numeric.pct_of(median, previous),
            "data_confidence_score": classify.data_confidence(F.col("listing_count"), s),
        }
    )


def rolling_rent(monthly: DataFrame, months: int = 3) -> DataFrame:
    """Average and median of the last `months` present months."""
    frame = by_month().rowsBetween(-(months - 1), 0)
    # `median` takes no frame; the frame holds `months` values at most.
    values = F.array_sort(F.collect_list("median_rent_ksh").over(frame))
    return monthly.withColumns(
        {
            "rolling_avg_rent_ksh": numeric.round_to(F.avg("avg_rent_ksh").over(frame), 2),
            "_values": values,
        }
    ).select(
        "*",
        (
            (F.get("_values", F.floor((F.size("_values") - 1) / 2).cast("int"))
            + F.get("_values", F.floor(F.size("_values") / 2).cast("int"))) / 2
        ).alias("rolling_median_rent_ksh"),
    ).drop("_values")


def yearly_change(monthly: DataFrame) -> DataFrame:
    """Change against the same calendar month a year earlier; null when absent."""
    earlier = monthly.select(
        "neighbourhood",
        F.add_months("month_start", 12).alias("month_start"),
        F.col("median_rent_ksh").alias("year_ago_median"),
    )
    return monthly.join(earlier, ["neighbourhood", "month_start"], "left").withColumn(
        "yoy_rent_change_pct",
        numeric.pct_of(F.col("median_rent_ksh"), F.col("year_ago_median")),
    )


def price_points(enriched: DataFrame, calendar: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """One row per listing with both axes, for charts."""
    points = chartable(enriched, s)
    months = calendar.select("date_day", "month_year")
    return points.join(months, points["scraped_date"] == months["date_day"], "left").select(
        "property_id", "title", "source_url", "neighbourhood", "value_zone", "commute_tier",
        "bedroom_label", "property_type", "price_bucket",
        F.col("dist_to_archives_km").cast("decimal(10,2)").alias("dist_to_archives_km"),
        F.col("price_ksh").cast("decimal(12,2)").alias("price_ksh"),
        "bedrooms", "bathrooms", "is_sweet_spot", "neighbourhood_median_ksh",
        "price_vs_neighbourhood_median", "scraped_date", "month_year", "latitude", "longitude",
        text.tooltip(F.col("neighbourhood"), F.col("bedroom_label"), F.col("price_ksh")).alias(
            "tooltip_label"
        ),
    )
