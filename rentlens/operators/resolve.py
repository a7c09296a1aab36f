"""Location text to place: cache, then fuzzy match, then lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, Settings
from rentlens.functions.geo import geodesic_km
from rentlens.functions.text import first_part
from rentlens.operators.fuzzy import best_by_edits, best_matches
from rentlens.operators.spool import spool
from rentlens.sources.gazetteer import NAMES, gazetteer

PLACE = ["matched_name", "lat", "lon"]


def distinct_texts(df: DataFrame, column: str = "location_raw") -> DataFrame:
    """The texts worth resolving; resolution work grows with these, not with rows."""
    return df.select(F.col(column).alias("raw_string")).filter("raw_string != ''").distinct()


def from_cache(texts: DataFrame, cache: DataFrame) -> DataFrame:
    """Exact lookup without regard to case. The first inserted row of a text wins."""
    first = (
        cache.groupBy(F.lower("raw_string").alias("_key"))
        .agg(F.min_by(F.struct(*PLACE), "inserted").alias("_hit"))
    )
    return texts.join(first, F.lower(texts["raw_string"]) == first["_key"]).select(
        texts["raw_string"], *[F.col(f"_hit.{c}").alias(c) for c in PLACE]
    )


def from_gazetteer(
    texts: DataFrame, s: Settings = DEFAULTS, match_case: bool = False, places: DataFrame | None = None
) -> DataFrame:
    """Best known place by the weighted scorer, at or above the cutoff; the place of lower
    `pos` wins a tie. `places`: pos, name, lat, lon, of any number.

    Only equal letters score 100, so a join settles those texts.
    """
    places = gazetteer(texts.sparkSession) if places is None else places
    key, name_key = F.col("raw_string"), F.col("name")
    if not match_case:
        key, name_key = F.lower(key), F.lower(name_key)
    found = ["raw_string", F.col("name").alias("matched_name"), "lat", "lon"]
    first = places.groupBy(name_key.alias("_key")).agg(F.min_by(F.struct("name", "lat", "lon"), "pos").alias("_place"))
    equal = texts.join(first, key == first["_key"]).select("raw_string", "_place.*").select(*found, F.lit(100.0).alias("score"))
    matches = best_matches(texts.join(equal, "raw_string", "left_anti"), places, s.fuzzy_cutoff, match_case)
    return equal.unionByName(matches.join(places, "pos").select(*found, "score"))


def from_gazetteer_by_edits(texts: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Best known place by Levenshtein similarity alone, without leaving the JVM."""
    scored = texts.withColumn(
        "_match", best_by_edits(F.col("raw_string"), NAMES, s.fuzzy_cutoff)
    ).filter("_match IS NOT NULL")
    places = gazetteer(texts.sparkSession)
    return scored.join(places, F.col("_match.name") == places["name"]).select(
        "raw_string", F.col("name").alias("matched_name"), "lat", "lon",
        F.col("_match.score").alias("score"),
    )


def from_lookup(texts: DataFrame, lookup: DataFrame) -> DataFrame:
    """A supplied geocoder extract (query, address, lat, lon): the name is the
    first part of the address."""
    one = lookup.groupBy("query").agg(
        F.min(F.struct("address", "lat", "lon")).alias("_hit")
    )
    return texts.join(one, texts["raw_string"] == one["query"]).select(
        texts["raw_string"],
        first_part(F.col("_hit.address"), ",").alias("matched_name"),
        F.col("_hit.lat").alias("lat"),
        F.col("_hit.lon").alias("lon"),
    )


def resolve_texts(
    texts: DataFrame, cache: DataFrame, lookup: DataFrame, s: Settings = DEFAULTS
) -> DataFrame:
    """Each resolved text with its place and the stage that found it.

    Texts and fuzzy matches feed more than one stage, so each is written once.
    """

    def staged(found: DataFrame, stage: str) -> DataFrame:
        return found.select("raw_string", *PLACE, F.lit(stage).alias("stage"))

    texts = spool(texts)
    cached = from_cache(texts, cache)
    uncached = texts.join(cached, "raw_string", "left_anti")
    matched = spool(from_gazetteer(uncached, s))
    unmatched = uncached.join(matched, "raw_string", "left_anti")
    return (
        staged(cached, "cache")
        .unionByName(staged(matched, "fuzzy"))
        .unionByName(staged(from_lookup(unmatched, lookup), "lookup"))
    )


def with_place(df: DataFrame, resolved: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Adds neighbourhood, coordinates and the distance from the fixed point.

    The distance is computed once per resolved text, before the join back.
    """
    places = resolved.select(
        F.col("raw_string").alias("_text"),
        "matched_name",
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        geodesic_km(F.col("lat"), F.col("lon"), s.origin_lat, s.origin_lon).alias(
            "dist_to_archives_km"
        ),
    )
    return (
        df.join(places, df["location_raw"] == places["_text"], "left")
        .withColumn("neighbourhood", F.coalesce("matched_name", F.lit("Unknown")))
        .drop("_text", "matched_name")
    )


def new_cache_rows(resolved: DataFrame) -> DataFrame:
    """What this batch learned beyond the cache."""
    return resolved.filter(F.col("stage") != "cache").select("raw_string", *PLACE)
