"""End-to-end models Q1 to Q10 and Q13."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.operators.filters import quality_gate
from rentlens.operators.spool import spool
from rentlens.plans import gold, marts, staging
from rentlens.plans.enriched import enriched_listings
from rentlens.registry import base
from rentlens.registry.base import query
from rentlens.registry.layers import out

STAGED_TIMES = ("scraped_at_eat", "firehose_arrival_at")


@query("q1_staging", out("stg", ("scraped_date",), STAGED_TIMES))
def q1(spark, folder):
    return staging.staged_listings(base.landed(spark, folder))


@query("q2_enriched", out("enr", ("scraped_date",), STAGED_TIMES))
def q2(spark, folder):
    return base.enriched(spark, folder)


@query("q3_date_dimension", out("calendar", ("date_day", "month_start")))
def q3(spark, folder):
    return base.calendar(spark, folder)


@query(
    "q4_neighbourhood_dimension",
    out("places", ("first_listing_date", "last_update_date"), ("updated_at",)),
)
def q4(spark, folder):
    return gold.neighbourhood_dimension(base.enriched(spark, folder), base.asof(spark, folder))


@query("q5_listings_fact", out("fact", ("scraped_date",), (*STAGED_TIMES, "loaded_at")))
def q5(spark, folder):
    return gold.listings_fact(base.enriched(spark, folder), base.asof(spark, folder))


@query("q6_neighbourhood_stats", out("stats", ("first_seen", "last_seen"), ("updated_at",)))
def q6(spark, folder):
    return base.stats(spark, folder)


@query("q7_value_ranking", out("finder", ("first_seen", "last_seen"), ("updated_at",)))
def q7(spark, folder):
    return base.finder(spark, folder)


def every_delivery(spark, folder) -> DataFrame:
    """Enriched rows of all deliveries, not only the latest of each listing."""
    rows = staging.cleaned_rows(quality_gate(base.landed(spark, folder)))
    return spool(enriched_listings(spool(rows)))


def monthly(spark, folder) -> DataFrame:
    rows = every_delivery(spark, folder)
    return marts.monthly_metrics(
        rows, base.calendar(spark, folder), gold.neighbourhood_dimension(rows)
    ).withColumns(
        {c: F.col(c).cast("double") for c in ("min_rent_ksh", "max_rent_ksh")}
    )


@query("q8_rent_trends", out("trends", ("month_start",)))
def q8(spark, folder):
    rows = every_delivery(spark, folder)
    places = spool(gold.neighbourhood_dimension(rows))
    return marts.trend_rows(gold.listings_fact(rows), base.calendar(spark, folder), places)


@query("q9_price_points", out("points", ("scraped_date",)))
def q9(spark, folder):
    return marts.price_points(base.enriched(spark, folder), base.calendar(spark, folder))
