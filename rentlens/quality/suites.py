"""Which rules guard which layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens import config
from rentlens.config import DEFAULTS, Settings
from rentlens.functions.dates import utc_timestamp
from rentlens.quality import assertions, gates, rules
from rentlens.quality.rules import Rule


def batch_source_rules(min_rows: int = 100) -> list[Rule]:
    return [
        rules.row_count_over(min_rows),
        *[rules.complete(c) for c in ("property_id", "scraped_at", "ingested_at", "source_url")],
    ]


def batch_cleaned_rules(s: Settings = DEFAULTS) -> list[Rule]:
    return [
        rules.row_count_over(0),
        rules.complete("property_id"),
        rules.in_range("price_ksh", s.min_price, s.max_price),
        rules.in_set("value_zone", config.VALUE_ZONES),
        rules.in_set("price_bucket", config.PRICE_BUCKETS),
    ]


def landed_report(landed: DataFrame, asof: Column, s: Settings = DEFAULTS) -> DataFrame:
    stamped = landed.withColumn("observed_at", utc_timestamp(F.col("scraped_at")))
    return rules.evaluate(
        stamped,
        "landed",
        [
            rules.row_count_over(0),
            rules.complete("scraped_at"),
            rules.complete("firehose_arrival_at", severity="warn"),
            rules.recent_within("observed_at", asof, s.recency_hours),
            rules.recent_within("firehose_arrival_at", asof, s.warn_hours, severity="warn"),
            rules.recent_within("firehose_arrival_at", asof, s.error_hours),
        ],
    )


def batch_report(
    landed: DataFrame, batch: DataFrame, asof: Column, s: Settings = DEFAULTS
) -> DataFrame:
    """The batch job's rules over its result, and the gate on both inputs."""
    counts = gates.fresh_counts(landed, batch, asof, s)
    return rules.combine(
        [
            rules.evaluate(batch, "batch", batch_cleaned_rules(s)),
            rules.assertion(counts.filter(~F.col("is_open")), "batch", "both_inputs_fresh"),
        ]
    )


def staged_report(staged: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    return rules.evaluate_keyed(
        staged,
        "staged",
        [
            rules.complete("property_id"),
            rules.in_range("dist_to_archives_km", 0, 100),
            rules.in_set("value_zone", config.VALUE_ZONES),
            rules.in_range("price_ksh", s.min_price, s.max_price),
        ],
        ["property_id"],
    )


def enriched_report(enriched: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    median, pct = F.col("neighbourhood_median_ksh"), F.col("price_vs_neighbourhood_median")
    return rules.combine(
        [
            rules.evaluate(
                enriched,
                "enriched",
                [
                    rules.expression("median > 0", median > 0, median.isNotNull()),
                    rules.in_set("commute_tier", config.COMMUTE_TIERS),
                    rules.in_set("location_segment", config.LOCATION_SEGMENTS),
                    rules.in_set("is_sweet_spot", [True, False]),
                    rules.in_set("bedroom_label", config.BEDROOM_LABELS),
                    rules.expression(
                        "pct plausible", pct.between(-100, 1000), pct.isNotNull()
                    ),
                    rules.none_of("geographic_alignment", assertions.misaligned()),
                    rules.none_of("neighbourhood_maths", assertions.miscalculated()),
                    rules.none_of("orphan_medians", assertions.without_median()),
                    rules.none_of("percentage_direction", assertions.misdirected()),
                    rules.none_of("sweet_spot_rules", assertions.false_bargain(s)),
                ],
            ),
            rules.assertion(assertions.bedroom_pricing(enriched), "enriched", "bedroom_pricing"),
        ]
    )


def star_report(
    enriched: DataFrame, fact: DataFrame, calendar: DataFrame, places: DataFrame
) -> DataFrame:
    """The fact meets its parents before it is counted, so both relationships and both
    keys ride on the pass of its rules."""
    place = places.select(F.col("neighbourhood").alias("_place")).distinct()
    day = calendar.select(F.col("date_day").alias("_day")).distinct()
    met = (
        fact.select("property_id", "price_ksh", "neighbourhood", "scraped_date")
        .join(place, F.col("neighbourhood") == F.col("_place"), "left")
        .join(day, F.col("scraped_date") == F.col("_day"), "left")
    )

    def orphaned(column: str, parent: str) -> rules.Rule:
        without = F.col(column).isNotNull() & F.col(parent).isNull()
        return rules.none_of(f"{column} has parent", without)

    return rules.combine(
        [
            rules.evaluate_keyed(
                met,
                "fact",
                [
                    rules.complete("property_id"),
                    rules.complete("price_ksh"),
                    orphaned("neighbourhood", "_place"),
                    orphaned("scraped_date", "_day"),
                ],
                ["property_id", "scraped_date"],
                ["property_id"],
            ),
            rules.assertion(assertions.leakage(enriched, fact), "fact", "leakage"),
            rules.evaluate_keyed(
                calendar, "calendar", [rules.complete("date_day")], ["date_day"]
            ),
            rules.evaluate_keyed(
                places,
                "places",
                [
                    rules.complete("neighbourhood"),
                    rules.in_set("commute_tier", config.COMMUTE_TIERS),
                ],
                ["neighbourhood"],
            ),
        ]
    )


def marts_report(
    stats: DataFrame, finder: DataFrame, trends: DataFrame, points: DataFrame,
    s: Settings = DEFAULTS,
) -> DataFrame:
    return rules.combine(
        [
            rules.evaluate_keyed(
                stats,
                "stats",
                [rules.complete("neighbourhood"), rules.complete("value_rank")],
                ["neighbourhood"],
            ),
            rules.assertion(
                assertions.rank_one_benchmarks(stats), "stats", "rank_one_benchmarks"
            ),
            rules.evaluate_keyed(
                finder,
                "finder",
                [
                    *finder_rules(s),
                    rules.none_of("score_deviation", assertions.deviates(s)),
                    rules.none_of("verdict_contract", assertions.breaks_contract()),
                ],
                ["neighbourhood"],
            ),
            rules.assertion(assertions.rank_order(finder), "finder", "rank_order"),
            rules.evaluate(
                trends, "trends", [rules.complete("neighbourhood"), rules.complete("month_start")]
            ),
            rules.evaluate_keyed(
                points,
                "points",
                [rules.complete("property_id"), rules.complete("dist_to_archives_km")],
                ["property_id"],
            ),
        ]
    )


def finder_rules(s: Settings = DEFAULTS) -> list[Rule]:
    required = [
        "neighbourhood", "overall_value_rank", "composite_score", "price_rank", "distance_rank",
        "consistency_rank", "verdict", "dist_to_archives_km", "value_zone", "median_rent_ksh",
        "avg_rent_ksh", "total_listings", "sweet_spot_pct",
    ]
    return [
        *[rules.complete(c) for c in required],
        *[
            rules.in_range(c, 1)
            for c in ("overall_value_rank", "price_rank", "distance_rank", "consistency_rank")
        ],
        rules.in_range("composite_score", 0),
        rules.in_range("dist_to_archives_km", 0, 60),
        rules.in_range("median_rent_ksh", s.min_price, s.max_price),
        rules.in_range("avg_rent_ksh", s.min_price, s.max_price),
        rules.in_range("affordability_index", 0),
        rules.in_range("iqr_rent_ksh", 0),
        rules.in_range("total_listings", s.min_support),
        rules.in_range("sweet_spot_pct", 0, 100),
        rules.in_set("verdict", config.VERDICTS),
        rules.in_set("value_zone", config.VALUE_ZONES),
    ]
