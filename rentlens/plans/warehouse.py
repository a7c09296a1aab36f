"""All layers from one landed table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from rentlens.config import DEFAULTS, Settings
from rentlens.operators.spool import spool
from rentlens.plans import enriched as enriched_plan
from rentlens.plans import gold, marts, staging
from rentlens.quality import rules, suites


@dataclass(frozen=True)
class Warehouse:
    landed: DataFrame
    staged: DataFrame
    enriched: DataFrame
    calendar: DataFrame
    places: DataFrame
    fact: DataFrame
    stats: DataFrame
    finder: DataFrame
    trends: DataFrame
    points: DataFrame


def build(landed: DataFrame, asof: Column | None = None, s: Settings = DEFAULTS) -> Warehouse:
    """Layers with several readers are spooled, the others stay lazy."""
    staged = spool(staging.staged_listings(landed, s))
    enriched = spool(enriched_plan.enriched_listings(staged, s))
    start, end = gold.covering_dates(enriched, "scraped_date")
    calendar = gold.date_dimension(landed.sparkSession, start, end)
    places = spool(gold.neighbourhood_dimension(enriched, asof))
    fact = spool(gold.listings_fact(enriched, asof))
    stats = spool(marts.stats_rows(enriched, asof, s))
    finder = spool(marts.finder_rows(stats, s))
    return Warehouse(
        landed=landed,
        staged=staged,
        enriched=enriched,
        calendar=calendar,
        places=places,
        fact=fact,
        stats=stats,
        finder=finder,
        trends=marts.trend_rows(fact, calendar, places, s),
        points=marts.price_points(enriched, calendar, s),
    )


def quality_report(
    w: Warehouse, asof: Column, s: Settings = DEFAULTS, batch: DataFrame | None = None
) -> DataFrame:
    """One row per rule over every layer, and over the batch job's result where given."""
    extra = [] if batch is None else [suites.batch_report(w.landed, batch, asof, s)]
    return rules.combine(
        [
            *extra,
            suites.landed_report(w.landed, asof, s),
            suites.staged_report(w.staged, s),
            suites.enriched_report(w.enriched, s),
            suites.star_report(w.enriched, w.fact, w.calendar, w.places),
            suites.marts_report(w.stats, w.finder, w.trends, w.points, s),
        ]
    )
