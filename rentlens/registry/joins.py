"""Joins (J) and place resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from rentlens.config import DEFAULTS
from rentlens.operators import resolve, upsert
from rentlens.operators.percentiles import grouped_percentiles
from rentlens.operators.spool import spool
from rentlens.plans import gold
from rentlens.plans.enriched import neighbourhood_medians
from rentlens.quality.rules import orphans
from rentlens.registry import base
from rentlens.registry.base import query
from rentlens.registry.filters import STAGE, TARGET, split_by_arrival
from rentlens.registry.layers import over
from rentlens.registry.models import every_delivery
from rentlens.sources.driver_tables import table
from rentlens.sources.gazetteer import PLACES


@query(
    "j1_group_median",
    over(
        "medians",
        """SELECT s.property_id, s.neighbourhood, m.neighbourhood_median_ksh
           FROM stg s LEFT JOIN medians m ON s.neighbourhood = m.neighbourhood""",
    ),
)
def j1(spark, folder):
    rows = base.staged(spark, folder)
    medians = spool(neighbourhood_medians(rows))
    return rows.join(medians, "neighbourhood", "left").select(
        "property_id", "neighbourhood", "neighbourhood_median_ksh"
    )


@query(
    "j2_base_with_statistics",
    over(
        "aggregated",
        """SELECT b.neighbourhood, count(*) AS total_listings, g.p50 AS median_rent_ksh,
             s.p50 AS median_1br_rent_ksh
           FROM enr b
           JOIN (SELECT neighbourhood, quantile_cont(CAST(price_ksh AS DOUBLE), 0.5) AS p50
                 FROM enr WHERE neighbourhood IS NOT NULL GROUP BY 1) g USING (neighbourhood)
           JOIN (SELECT neighbourhood, quantile_cont(CAST(CASE WHEN bedrooms = 1 THEN price_ksh END
                 AS DOUBLE), 0.5) AS p50
                 FROM enr WHERE neighbourhood IS NOT NULL GROUP BY 1) s USING (neighbourhood)
           GROUP BY b.neighbourhood, g.p50, s.p50""",
    ),
)
def j2(spark, folder):
    """Self-joins with statistics of the same rows are one grouping."""
    rows = spool(base.enriched(spark, folder)).dropna(subset=["neighbourhood"])
    spread = grouped_percentiles(
        rows,
        ["neighbourhood"],
        F.col("price_ksh"),
        {"median_rent_ksh": 0.5},
        subset=F.col("bedrooms") == 1,
        subset_points={"median_1br_rent_ksh": 0.5},
    )
    counts = rows.groupBy("neighbourhood").agg(F.count("*").alias("total_listings"))
    return counts.join(spread, "neighbourhood")


@query(
    "j3_star_join",
    over(
        "monthly",
        """SELECT f.property_id, f.price_ksh, d.month_year, n.value_zone FROM allint f
           JOIN calendar d ON f.scraped_date = d.date_day
           JOIN allplaces n ON f.neighbourhood = n.neighbourhood""",
    ),
)
def j3(spark, folder):
    rows = every_delivery(spark, folder)
    fact = gold.listings_fact(rows)
    places = spool(gold.neighbourhood_dimension(rows)).select("neighbourhood", "value_zone")
    days = base.calendar(spark, folder).select("date_day", "month_year")
    return (
        fact.join(days, fact["scraped_date"] == days["date_day"])
        .join(places, "neighbourhood")
        .select(
            "property_id",
            F.col("price_ksh").cast("int").alias("price_ksh"),
            "month_year",
            "value_zone",
        )
    )


@query(
    "j4_date_left_join",
    over(
        "calendar",
        """SELECT s.property_id, d.month_year FROM stg s LEFT JOIN
           (SELECT * FROM calendar WHERE year < 2000) d ON s.scraped_date = d.date_day""",
    ),
)
def j4(spark, folder):
    rows = base.staged(spark, folder)
    days = base.calendar(spark, folder).filter("year < 2000").select("date_day", "month_year")
    return rows.join(days, rows["scraped_date"] == days["date_day"], "left").select(
        "property_id", "month_year"
    )


@query(
    "j5_against_one_row",
    """SELECT o_orderkey, o_totalprice, b.top FROM orders
       CROSS JOIN (SELECT avg(o_totalprice) AS mean, max(o_totalprice) AS top FROM orders) b
       WHERE o_totalprice > 1.5 * b.mean""",
)
def j5(spark, folder):
    """A one-row aggregate beside every row is a scalar subquery."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    mean = orders.select(F.avg("o_totalprice")).scalar()
    top = orders.select(F.max("o_totalprice")).scalar()
    return orders.filter(F.col("o_totalprice") > 1.5 * mean).withColumn("top", top)


@query(
    "j6_delete_using",
    over(
        "raw",
        f"""SELECT t.property_id, t.arrival_seq FROM {TARGET} t
            WHERE t.property_id NOT IN (SELECT property_id FROM {STAGE})""",
    ),
)
def j6(spark, folder):
    target, stage = split_by_arrival(spark, folder)
    return upsert.delete_using(target, stage, ["property_id"]).select(
        "property_id", "arrival_seq"
    )


@query(
    "j7_orphans",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def j7(spark, folder):
    parents = table(spark, folder, "customer").filter("c_acctbal > 0")
    return orphans(table(spark, folder, "orders"), parents, "o_custkey", "c_custkey").select(
        "o_orderkey", "o_custkey"
    )


NAMES_SQL = "(VALUES " + ", ".join(
    f"({i}, '{name}', {lat}e0, {lon}e0)" for i, (name, lat, lon) in enumerate(PLACES)
) + ") AS g(pos, name, lat, lon)"


def worded_locations(spark, folder):
    """Location texts around known names: exact, misspelt, suffixed, unknown.

    One text per order, drawn from the gazetteer by customer; some customers name
    a place of their own, so distinct texts grow with the tables.
    """
    spots = spark.createDataFrame(
        [(i, name) for i, (name, _, _) in enumerate(PLACES)], "pos long, name string"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    joined = orders.join(spots, F.col("o_custkey") % len(PLACES) == F.col("pos"))
    name, arm = F.col("name"), F.col("o_custkey") % 6
    return joined.select(
        "o_orderkey",
        F.when(arm == 0, name)
        .when(arm == 1, F.concat(F.substring(name, 1, 3), F.substring(name, 5, 100)))
        .when(arm == 2, F.upper(name))
        .when(arm == 3, F.concat(name, F.lit(", Nairobi")))
        .when(arm == 4, F.concat(F.lit("Plot "), F.col("o_custkey").cast("string")))
        .otherwise(F.lit(""))
        .alias("location_raw"),
    )


WORDED = f"""worded AS (SELECT o_orderkey, CASE o_custkey % 6 WHEN 0 THEN name
    WHEN 1 THEN substr(name, 1, 3) || substr(name, 5) WHEN 2 THEN upper(name)
    WHEN 3 THEN name || ', Nairobi' WHEN 4 THEN 'Plot ' || o_custkey ELSE '' END AS location_raw
  FROM orders JOIN {NAMES_SQL} ON o_custkey % {len(PLACES)} = g.pos),
texts AS (SELECT DISTINCT location_raw AS raw_string FROM worded WHERE location_raw <> '')"""


@query(
    "j8_fuzzy_by_edits",
    f"""WITH {WORDED}
      SELECT w.o_orderkey, w.location_raw, b.name AS matched_name, b.score FROM worded w
      LEFT JOIN (SELECT raw_string, name, score FROM (
          SELECT raw_string, name, pos, CAST(100 AS DOUBLE) * (CAST(1 AS DOUBLE)
            - levenshtein(lower(raw_string), lower(name))
              / CAST(greatest(length(raw_string), length(name)) AS DOUBLE)) AS score
          FROM texts, {NAMES_SQL})
        WHERE score >= 80
        QUALIFY row_number() OVER (PARTITION BY raw_string ORDER BY score DESC, pos) = 1) b
      ON w.location_raw = b.raw_string""",
)
def j8_edits(spark, folder):
    rows = worded_locations(spark, folder)
    matches = resolve.from_gazetteer_by_edits(resolve.distinct_texts(rows))
    return rows.join(matches, rows["location_raw"] == matches["raw_string"], "left").select(
        "o_orderkey", "location_raw", "matched_name", "score"
    )


@query(
    "j8_fuzzy_weighted",
    f"""WITH {WORDED}, scored AS (
        SELECT raw_string, name, pos, greatest(
          CASE WHEN lower(raw_string) = lower(name) THEN 100e0 END,
          CASE WHEN lower(raw_string) = lower(substr(name, 1, 3) || substr(name, 5))
            AND raw_string <> name THEN 200e0 * length(raw_string) / (length(raw_string) + length(name)) END,
          CASE WHEN (contains(lower(raw_string), lower(name)) OR contains(lower(name), lower(raw_string)))
            AND greatest(length(raw_string), length(name)) >= 1.5 * least(length(raw_string), length(name))
            THEN 90e0 END) AS score
        FROM texts, {NAMES_SQL})
      SELECT o_orderkey, location_raw, b.name AS matched_name, b.score FROM worded w
      LEFT JOIN (SELECT raw_string, name, score FROM scored WHERE score >= 80
        QUALIFY row_number() OVER (PARTITION BY raw_string ORDER BY score DESC, pos) = 1) b
      ON w.location_raw = b.raw_string""",
)
def j8_weighted(spark, folder):
    """What the weights must give for texts made from names: equal letters 100, one letter
    lost the share of letters that is left, a name inside a longer text 90, the earliest
    of several."""
    rows = worded_locations(spark, folder)
    matches = resolve.from_gazetteer(resolve.distinct_texts(rows))
    return rows.join(matches, rows["location_raw"] == matches["raw_string"], "left").select(
        "o_orderkey", "location_raw", "matched_name", "score"
    )


def cache_rows(spark, folder):
    """A cache from the nation table; later rows of a text must not win."""
    nation = table(spark, folder, "nation")
    first = nation.filter("n_nationkey % 3 <> 0").select(
        F.concat(F.col("n_name"), F.lit(" Estate")).alias("raw_string"),
        F.initcap("n_name").alias("matched_name"),
        (F.col("n_nationkey") / -100.0).alias("lat"),
        (F.col("n_nationkey") + 36.5).alias("lon"),
        F.col("n_nationkey").cast("long").alias("inserted"),
    )
    later = first.withColumns(
        {
            "raw_string": F.lower("raw_string"),
            "matched_name": F.lit("stale"),
            "inserted": F.col("inserted") + 1000,
        }
    )
    return first.unionByName(later)


def estates(spark, folder):
    """Customers' location texts: their nation's estate, in mixed case."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        "c_custkey",
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lower("n_name"), F.lit(" ESTATE")))
        .otherwise(F.concat("n_name", F.lit(" Estate")))
        .alias("location_raw"),
    )


ESTATES = """estates AS (SELECT c_custkey, n_nationkey, n_name,
  CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) || ' ESTATE' ELSE n_name || ' Estate' END
  AS location_raw FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
NATION_PROPER = "upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2))"


@query(
    "j9_cache_lookup",
    f"""WITH {ESTATES} SELECT c_custkey, location_raw,
          CASE WHEN n_nationkey % 3 <> 0 THEN {NATION_PROPER} END AS matched_name,
          CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey / -100e0 END AS lat FROM estates""",
)
def j9(spark, folder):
    rows = estates(spark, folder)
    hits = resolve.from_cache(resolve.distinct_texts(rows), cache_rows(spark, folder))
    return rows.join(hits, rows["location_raw"] == hits["raw_string"], "left").select(
        "c_custkey", "location_raw", "matched_name", "lat"
    )


def lookup_rows(spark, folder):
    """A geocoder extract: every sixth nation's estate, in both spellings."""
    nation = table(spark, folder, "nation").filter("n_nationkey % 6 = 0")
    spelling = F.explode(
        F.array(
            F.concat("n_name", F.lit(" Estate")),
            F.concat(F.lower("n_name"), F.lit(" ESTATE")),
        )
    )
    return nation.select(
        spelling.alias("query"),
        F.concat(F.lit("Area "), F.col("n_nationkey").cast("string"), F.lit(", Nairobi, Kenya"))
        .alias("address"),
        (F.col("n_nationkey") / -200.0).alias("lat"),
        (F.col("n_nationkey") + 36.0).alias("lon"),
    )


@query(
    "j10_resolution_cascade",
    f"""WITH {ESTATES} SELECT c_custkey,
          CASE WHEN n_nationkey % 3 <> 0 THEN {NATION_PROPER}
               WHEN n_nationkey % 6 = 0 THEN 'Area ' || n_nationkey ELSE 'Unknown' END
            AS neighbourhood,
          CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey / -100e0
               WHEN n_nationkey % 6 = 0 THEN n_nationkey / -200e0 END AS latitude,
          CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey + 36.5e0
               WHEN n_nationkey % 6 = 0 THEN n_nationkey + 36.0e0 END AS longitude FROM estates""",
)
def j10(spark, folder):
    rows = estates(spark, folder)
    resolved = resolve.resolve_texts(
        resolve.distinct_texts(rows), cache_rows(spark, folder), lookup_rows(spark, folder),
        DEFAULTS,
    )
    return resolve.with_place(rows, resolved).select(
        "c_custkey", "neighbourhood", "latitude", "longitude"
    )
