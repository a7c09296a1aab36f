"""Quality rules (D) and the report over all layers (Q13).

Rules are run where they find something: on raw deliveries, or on a model that
was broken on purpose in the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens import config
from rentlens.operators.filters import quality_gate
from rentlens.operators.spool import spool
from rentlens.plans import gold, staging, warehouse
from rentlens.quality import assertions, gates, rules, suites
from rentlens.registry import base
from rentlens.registry.base import query
from rentlens.registry.filters import broken_finder
from rentlens.registry.layers import ASOF, SCORE, over
from rentlens.sources.driver_tables import table


def report_sql(layer: str, upto: str, lines: list[tuple[str, str, str]]) -> str:
    """Report rows from (rule, severity, SQL giving the number of failures)."""
    return over(upto, " UNION ALL ".join(report_line(layer, *line) for line in lines))


def report_line(layer: str, rule: str, severity: str, failed: str) -> str:
    bad = "warn" if severity == "warn" else "fail"
    return f"""SELECT '{layer}' AS layer, '{rule}' AS rule, '{severity}' AS severity,
      CAST(f AS BIGINT) AS failed, CASE WHEN f = 0 THEN 'pass' ELSE '{bad}' END AS status
      FROM (SELECT {failed} AS f)"""


def count_of(source: str, condition: str) -> str:
    return f"(SELECT count(*) FROM {source} WHERE {condition})"


def repeats_of(source: str, *columns: str) -> str:
    keys = ", ".join(columns)
    some = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        f"(SELECT count(*) FROM (SELECT {keys} FROM {source} WHERE {some} "
        f"GROUP BY {keys} HAVING count(*) > 1))"
    )


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@query(
    "d1_row_count",
    report_sql(
        "raw",
        "raw",
        [
            ("row_count > 100", "error", "(SELECT CASE WHEN count(*) > 100 THEN 0 ELSE 1 END FROM raw)"),
            ("row_count > 100000000000", "error",
             "(SELECT CASE WHEN count(*) > 100000000000 THEN 0 ELSE 1 END FROM raw)"),
        ],
    ),
)
def d1(spark, folder):
    wanted = [rules.row_count_over(100), rules.row_count_over(100_000_000_000)]
    return rules.evaluate(base.raw(spark, folder), "raw", wanted)


@query(
    "d2_complete",
    report_sql(
        "raw",
        "raw",
        [
            (f"{c} complete", "error", count_of("raw", f"{c} IS NULL"))
            for c in ("property_id", "neighbourhood", "dist_to_archives_km")
        ],
    ),
)
def d2(spark, folder):
    wanted = [
        rules.complete(c) for c in ("property_id", "neighbourhood", "dist_to_archives_km")
    ]
    return rules.evaluate(base.raw(spark, folder), "raw", wanted)


@query(
    "d3_range",
    report_sql(
        "raw",
        "raw",
        [
            ("price_ksh in 3000..2000000", "error",
             count_of("raw", "price_ksh < 3000 OR price_ksh > 2000000")),
            ("bedrooms in 0..", "error", count_of("raw", "bedrooms < 0")),
            ("dist_to_archives_km in ..15", "error",
             count_of("raw", "price_ksh > 50000 AND dist_to_archives_km > 15")),
        ],
    ),
)
def d3(spark, folder):
    wanted = [
        rules.in_range("price_ksh", 3000, 2_000_000),
        rules.in_range("bedrooms", low=0),
        rules.in_range("dist_to_archives_km", high=15, where=F.col("price_ksh") > 50_000),
    ]
    return rules.evaluate(base.raw(spark, folder), "raw", wanted)


@query(
    "d4_accepted_values",
    report_sql(
        "raw",
        "raw",
        [
            ("property_type accepted", "error",
             count_of("raw", "property_type NOT IN ('HOUSEHOLD', 'MACHINERY')")),
            ("bedrooms accepted", "error", count_of("raw", "bedrooms NOT IN (0, 1, 2)")),
        ],
    ),
)
def d4(spark, folder):
    wanted = [
        rules.in_set("property_type", ["HOUSEHOLD", "MACHINERY"]),
        rules.in_set("bedrooms", [0, 1, 2]),
    ]
    return rules.evaluate(base.raw(spark, folder), "raw", wanted)


@query(
    "d5_unique",
    report_sql(
        "raw",
        "raw",
        [
            ("property_id unique", "error", repeats_of("raw", "property_id")),
            ("arrival_seq unique", "error", repeats_of("raw", "arrival_seq")),
        ],
    ),
)
def d5(spark, folder):
    rows = base.raw(spark, folder)
    return rules.unique(rows, "raw", "property_id").unionByName(
        rules.unique(rows, "raw", "arrival_seq")
    )


@query(
    "d6_unique_combination",
    report_sql(
        "lineitem",
        "raw",
        [
            ("l_orderkey, l_linenumber unique", "error",
             repeats_of("lineitem", "l_orderkey", "l_linenumber")),
            ("l_partkey, l_suppkey unique", "error",
             repeats_of("lineitem", "l_partkey", "l_suppkey")),
        ],
    ),
)
def d6(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rules.unique(lines, "lineitem", "l_orderkey", "l_linenumber").unionByName(
        rules.unique(lines, "lineitem", "l_partkey", "l_suppkey")
    )


@query(
    "d7_relationship",
    report_sql(
        "orders",
        "raw",
        [
            ("o_custkey has parent", "error",
             count_of("orders", "o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")),
        ],
    ),
)
def d7(spark, folder):
    parents = table(spark, folder, "customer").filter("c_acctbal > 0")
    return rules.relationship(
        table(spark, folder, "orders"), parents, "orders", "o_custkey", "c_custkey"
    )


@query(
    "d8_expression",
    report_sql(
        "enriched",
        "enr",
        [
            ("median > 0", "error",
             count_of("enr", "neighbourhood_median_ksh IS NOT NULL AND NOT neighbourhood_median_ksh > 0")),
            ("pct below 10", "error",
             count_of("enr", "price_vs_neighbourhood_median IS NOT NULL "
                             "AND NOT price_vs_neighbourhood_median < 10")),
        ],
    ),
)
def d8(spark, folder):
    median, pct = F.col("neighbourhood_median_ksh"), F.col("price_vs_neighbourhood_median")
    return rules.evaluate(
        base.enriched(spark, folder),
        "enriched",
        [
            rules.expression("median > 0", median > 0, median.isNotNull()),
            rules.expression("pct below 10", pct < 10, pct.isNotNull()),
        ],
    )


def after_last_event(spark, folder, hours: int):
    newest = table(spark, folder, "events").agg(F.max("ts")).first()[0]
    return F.lit(newest.isoformat(sep=" ")).cast("timestamp_ntz") + F.expr(
        f"INTERVAL {hours} HOURS"
    )


@query(
    "d9_recency",
    " UNION ALL ".join(
        f"""SELECT 'at +{h} h' AS layer, 'ts within 26 h' AS rule, 'error' AS severity,
              CAST(CASE WHEN newest >= newest + INTERVAL {h} HOUR - INTERVAL 26 HOUR
                   THEN 0 ELSE 1 END AS BIGINT) AS failed,
              CASE WHEN newest >= newest + INTERVAL {h} HOUR - INTERVAL 26 HOUR
                   THEN 'pass' ELSE 'fail' END AS status
            FROM (SELECT max(ts) AS newest FROM events)"""
        for h in (20, 30)
    ),
)
def d9(spark, folder):
    events = table(spark, folder, "events")
    return rules.combine(
        [
            rules.evaluate(
                events,
                f"at +{h} h",
                [rules.recent_within("ts", after_last_event(spark, folder, h), 26)],
            )
            for h in (20, 30)
        ]
    )


@query(
    "d10_freshness",
    """SELECT CAST(h AS DOUBLE) AS age_hours,
         CASE WHEN h > 49 THEN 'error' WHEN h > 25 THEN 'warn' ELSE 'pass' END AS status
       FROM (SELECT max(ts) FROM events), (VALUES (1), (25), (30), (49), (50)) v(h)""",
)
def d10(spark, folder):
    events = table(spark, folder, "events")
    return rules.combine(
        [
            rules.freshness(events, "ts", after_last_event(spark, folder, h), 25, 49)
            for h in (1, 25, 30, 49, 50)
        ]
    )


@query(
    "d11_severity",
    report_sql(
        "raw",
        "raw",
        [
            ("neighbourhood complete", "warn", count_of("raw", "neighbourhood IS NULL")),
            ("dist_to_archives_km complete", "error",
             count_of("raw", "dist_to_archives_km IS NULL")),
            ("title complete", "warn", count_of("raw", "title IS NULL")),
        ],
    ),
)
def d11(spark, folder):
    return rules.evaluate(
        base.raw(spark, folder),
        "raw",
        [
            rules.complete("neighbourhood", severity="warn"),
            rules.complete("dist_to_archives_km"),
            rules.complete("title", severity="warn"),
        ],
    )


@query(
    "d12_halting_rules",
    over(
        "raw",
        "SELECT * FROM (" + " UNION ALL ".join(
            [
                report_line("source", "row_count > 100", "error",
                            "(SELECT CASE WHEN count(*) > 100 THEN 0 ELSE 1 END FROM raw)"),
                report_line("source", "source_url complete", "error",
                            count_of("raw", "arrival_seq % 3 = 0")),
            ]
        ) + ") WHERE status = 'fail'",
    ),
)
def d12(spark, folder):
    """What stops the batch job when some records have no url."""
    rows = base.raw(spark, folder).withColumn(
        "source_url", F.when(F.col("arrival_seq") % 3 != 0, F.col("source_url"))
    )
    report = spool(rules.evaluate(rows, "source", suites.batch_source_rules()))
    try:
        gates.halt_on_failure(report, "source")
    except gates.QualityError:
        return report.filter("status = 'fail'")
    return report.limit(0)


@query(
    "d13_both_inputs_fresh",
    over(
        "gated",
        f"""SELECT hours, stream_count, CASE WHEN hours <= 2 THEN cleaned ELSE 0 END AS batch_count,
              hours <= 2 AND stream_count > 0 AND cleaned > 0 AS is_open
            FROM (VALUES (24), (1)) AS age(hours), (SELECT count(*) AS cleaned FROM gated),
              (SELECT count(*) AS stream_count FROM raw
               WHERE firehose_arrival_at >= {ASOF} - INTERVAL 2 HOUR)""",
    ),
)
def d13(spark, folder):
    """A batch table cleaned a day ago keeps the gate shut, one of an hour ago opens it."""
    rows = base.raw(spark, folder)
    asof = base.asof(spark, folder)

    def counts(hours: int) -> DataFrame:
        stamp = (asof - F.expr(f"INTERVAL {hours} HOURS")).alias("batch_cleaned_at")
        return gates.fresh_counts(rows, quality_gate(rows).select(stamp), asof).withColumn(
            "hours", F.lit(hours)
        )

    return counts(24).unionByName(counts(1))


@query(
    "d14_leakage",
    over(
        "enr",
        """SELECT total_expected_rows, total_actual_rows,
             total_expected_rows - total_actual_rows AS dropped_rows_count FROM (SELECT
           (SELECT count(*) FROM enr WHERE neighbourhood IS NOT NULL AND scraped_date IS NOT NULL)
             AS total_expected_rows,
           (SELECT count(*) FROM enr WHERE neighbourhood IS NOT NULL AND scraped_date IS NOT NULL
             AND price_bucket <> '80k+') AS total_actual_rows)""",
    ),
)
def d14(spark, folder):
    rows = spool(base.enriched(spark, folder))
    fact = gold.listings_fact(rows).filter("price_bucket <> '80k+'")
    return assertions.leakage(rows, fact)


@query(
    "d15_bedroom_pricing",
    over(
        "enr",
        """SELECT * FROM (SELECT *, max(CASE WHEN bedroom_label = '1 BR' THEN avg_rent_ksh END)
               OVER (PARTITION BY neighbourhood) AS local_1br_avg_price
             FROM (SELECT neighbourhood, bedroom_label, avg(price_ksh) AS avg_rent_ksh FROM enr
                   WHERE price_ksh IS NOT NULL AND bedroom_label IS NOT NULL GROUP BY 1, 2))
           WHERE bedroom_label IN ('3 BR', '4+ BR') AND local_1br_avg_price IS NOT NULL
             AND avg_rent_ksh < local_1br_avg_price * CAST(0.8 AS DOUBLE)""",
    ),
)
def d15(spark, folder):
    return assertions.bedroom_pricing(base.enriched(spark, folder))


@query(
    "d16_geographic_alignment",
    over(
        "enr",
        """SELECT property_id, dist_to_archives_km, commute_tier, location_segment FROM
           (SELECT * REPLACE (CASE WHEN price_ksh % 2 = 0 THEN 'Commuter Zone'
              ELSE 'Core CBD / Inner Ring' END AS location_segment) FROM enr)
           WHERE (commute_tier IN ('1 - Walking (0-2 km)', '2 - Short (2-5 km)')
                  AND location_segment <> 'Core CBD / Inner Ring')
              OR (commute_tier = '3 - Medium (5-8 km)' AND location_segment NOT IN
                  ('Core CBD / Inner Ring', 'Mid-Ring Suburb'))
              OR (commute_tier = '5 - Far (15+ km)' AND location_segment = 'Core CBD / Inner Ring')""",
    ),
)
def d16(spark, folder):
    return assertions.geographic_alignment(
        base.enriched(spark, folder).withColumn(
            "location_segment",
            F.when(F.col("price_ksh") % 2 == 0, "Commuter Zone").otherwise(
                "Core CBD / Inner Ring"
            ),
        )
    )


BROKEN_ENR = """(SELECT * REPLACE (
   CASE WHEN price_ksh % 3 = 0 THEN NULL WHEN price_ksh % 7 = 0 THEN 0
        ELSE neighbourhood_median_ksh END AS neighbourhood_median_ksh,
   CASE WHEN price_ksh % 5 = 0 THEN NULL ELSE 0 - price_vs_neighbourhood_median END
     AS price_vs_neighbourhood_median,
   TRUE AS is_sweet_spot) FROM enr)"""


def broken_enriched(spark, folder):
    """Medians lost or zero, percentages lost or turned, every listing a bargain."""
    price = F.col("price_ksh")
    return base.enriched(spark, folder).withColumns(
        {
            "neighbourhood_median_ksh": F.when(price % 3 == 0, None)
            .when(price % 7 == 0, F.lit(0.0))
            .otherwise(F.col("neighbourhood_median_ksh")),
            "price_vs_neighbourhood_median": F.when(price % 5 == 0, None).otherwise(
                0 - F.col("price_vs_neighbourhood_median")
            ),
            "is_sweet_spot": F.lit(True),
        }
    )


@query(
    "d17_neighbourhood_maths",
    over(
        "enr",
        f"""SELECT property_id, neighbourhood, price_ksh, neighbourhood_median_ksh,
             price_vs_neighbourhood_median FROM {BROKEN_ENR}
           WHERE (neighbourhood IS NOT NULL AND price_ksh IS NOT NULL
                  AND neighbourhood_median_ksh IS NULL)
              OR (price_ksh IS NOT NULL AND neighbourhood_median_ksh IS NOT NULL
                  AND price_vs_neighbourhood_median IS NULL)
              OR neighbourhood_median_ksh = 0""",
    ),
)
def d17(spark, folder):
    return assertions.neighbourhood_maths(broken_enriched(spark, folder))


@query(
    "d18_orphan_medians",
    over(
        "enr",
        f"""SELECT property_id, neighbourhood, price_ksh, neighbourhood_median_ksh
            FROM {BROKEN_ENR} WHERE neighbourhood IS NOT NULL
              AND neighbourhood_median_ksh IS NULL""",
    ),
)
def d18(spark, folder):
    return assertions.orphan_medians(broken_enriched(spark, folder))


DIRECTION = """neighbourhood_median_ksh IS NOT NULL AND price_ksh IS NOT NULL AND (
   (abs(price_ksh - neighbourhood_median_ksh) * 100 >= neighbourhood_median_ksh * CAST(0.05 AS DOUBLE)
     AND ((price_ksh > neighbourhood_median_ksh AND price_vs_neighbourhood_median <= 0)
       OR (price_ksh < neighbourhood_median_ksh AND price_vs_neighbourhood_median >= 0)))
   OR (price_ksh = neighbourhood_median_ksh AND price_vs_neighbourhood_median <> 0))"""


@query(
    "d19_percentage_direction",
    over(
        "enr",
        f"""SELECT property_id, price_ksh, neighbourhood_median_ksh,
              price_vs_neighbourhood_median FROM {BROKEN_ENR} WHERE {DIRECTION}""",
    ),
)
def d19(spark, folder):
    return assertions.percentage_direction(broken_enriched(spark, folder))


SWEET = """is_sweet_spot AND (price_ksh >= 50000 OR dist_to_archives_km > 8.0
   OR price_ksh > neighbourhood_median_ksh)"""


@query(
    "d20_sweet_spot_rules",
    over(
        "enr",
        f"""SELECT property_id, price_ksh, dist_to_archives_km, neighbourhood_median_ksh,
              is_sweet_spot FROM {BROKEN_ENR} WHERE {SWEET}""",
    ),
)
def d20(spark, folder):
    return assertions.sweet_spot_rules(broken_enriched(spark, folder))


RANK_ONE = """SELECT m.neighbourhood, m.value_rank, m.price_rank, m.supply_rank,
      m.affordability_index, m.avg_rent_ksh, m.total_listings, b.* FROM {source} m
   CROSS JOIN (SELECT min(affordability_index) AS true_min_index,
      max(avg_rent_ksh) AS true_max_rent, max(total_listings) AS true_max_supply FROM {source}) b
   WHERE (m.value_rank = 1 AND m.affordability_index <> b.true_min_index)
      OR (m.price_rank = 1 AND m.avg_rent_ksh <> b.true_max_rent)
      OR (m.supply_rank = 1 AND m.total_listings <> b.true_max_supply)"""


@query(
    "d21_rank_one_benchmarks",
    over(
        "stats",
        RANK_ONE.format(
            source="(SELECT * REPLACE (CASE WHEN value_rank <= 5 THEN 1 ELSE value_rank END "
            "AS value_rank, CASE WHEN price_rank = 3 THEN 1 ELSE price_rank END AS price_rank) "
            "FROM stats)"
        ),
    ),
)
def d21(spark, folder):
    broken = base.stats(spark, folder).withColumns(
        {
            "value_rank": F.when(F.col("value_rank") <= 5, 1).otherwise(F.col("value_rank")),
            "price_rank": F.when(F.col("price_rank") == 3, 1).otherwise(F.col("price_rank")),
        }
    )
    return assertions.rank_one_benchmarks(spool(broken))


@query(
    "d22_score_deviation",
    over(
        "finder",
        f"""SELECT * FROM (SELECT neighbourhood, stored_score, expected_score,
              CAST(abs(CAST(stored_score AS DECIMAL(18,2)) - CAST(expected_score AS DECIMAL(18,2)))
                AS DOUBLE) AS deviation
            FROM (SELECT neighbourhood, composite_score
                    + CASE WHEN total_listings % 2 = 0 THEN 1 ELSE 0 END AS stored_score,
                    {SCORE} AS expected_score FROM finder)) WHERE deviation > 0.02""",
    ),
)
def d22(spark, folder):
    drifted = base.finder(spark, folder).withColumn(
        "composite_score",
        F.col("composite_score") + F.when(F.col("total_listings") % 2 == 0, 1).otherwise(0),
    )
    return assertions.score_deviation(drifted)


@query(
    "d23_rank_order",
    over(
        "finder",
        """SELECT (SELECT min(score) FROM broken WHERE overall_value_rank = 1) AS rank1_score,
             (SELECT min(score) FROM broken WHERE overall_value_rank = 2) AS rank2_score
           FROM (SELECT 1) WHERE rank1_score > rank2_score""",
    ).replace(
        "\nSELECT (SELECT",
        ",\nbroken AS (SELECT 100 - composite_score AS score, least(overall_value_rank, 2)"
        " AS overall_value_rank FROM finder)"
        "\nSELECT (SELECT",
    ),
)
def d23(spark, folder):
    """Scores turned upside down; all but the first share rank 2."""
    broken = base.finder(spark, folder).withColumns(
        {
            "composite_score": 100 - F.col("composite_score"),
            "overall_value_rank": F.least("overall_value_rank", F.lit(2)),
        }
    )
    return assertions.rank_order(spool(broken))


@query(
    "d24_verdict_contract",
    over(
        "finder",
        """SELECT failure_reason, count(*) AS n FROM (
             SELECT CASE WHEN total_listings % 2 = 0
                THEN CASE WHEN NOT (sweet_spot_pct >= 60 AND dist_to_archives_km <= 8)
                     THEN 'Project Star criteria violated' END
                ELSE CASE WHEN NOT (dist_to_archives_km <= 5 AND median_rent_ksh >= 50000)
                     THEN 'Premium Location criteria violated' END END AS failure_reason
             FROM finder) WHERE failure_reason IS NOT NULL GROUP BY 1""",
    ),
)
def d24(spark, folder):
    return (
        assertions.verdict_contract(broken_finder(spark, folder))
        .groupBy("failure_reason")
        .agg(F.count("*").alias("n"))
    )


def full_report_sql() -> str:
    s = config.DEFAULTS
    lines: list[tuple[str, str, str, str]] = []

    def add(layer: str, rule: str, failed: str, severity: str = "error") -> None:
        lines.append((layer, rule, severity, failed))

    def complete(layer: str, source: str, *columns: str, severity: str = "error") -> None:
        for c in columns:
            add(layer, f"{c} complete", count_of(source, f"{c} IS NULL"), severity)

    def within(layer: str, source: str, column: str, low, high=None) -> None:
        broken = f"{column} < {low}" + ("" if high is None else f" OR {column} > {high}")
        add(layer, f"{column} in {low}..{'' if high is None else high}", count_of(source, broken))

    def accepted(layer: str, source: str, column: str, values) -> None:
        add(layer, f"{column} accepted", count_of(source, f"{column} NOT IN ({quoted(values)})"))

    add("landed", "row_count > 0", "(SELECT CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM raw)")
    for hours, severity in ((s.warn_hours, "warn"), (s.error_hours, "error")):
        add("landed", f"firehose_arrival_at within {hours} h", f"""(SELECT CASE WHEN
            max(firehose_arrival_at) >= {ASOF} - INTERVAL {hours} HOUR THEN 0 ELSE 1 END FROM raw)""",
            severity)
    add("batch", "row_count > 0", "(SELECT CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM gated)")
    complete("batch", "gated", "property_id")
    within("batch", "gated", "price_ksh", s.min_price, s.max_price)
    accepted("batch", "stg", "value_zone", config.VALUE_ZONES)
    accepted("batch", "stg", "price_bucket", config.PRICE_BUCKETS)
    add("batch", "both_inputs_fresh", f"""(SELECT CASE WHEN (SELECT count(*) FROM gated) > 0
        AND max(firehose_arrival_at) >= {ASOF} - INTERVAL 2 HOUR THEN 0 ELSE 1 END FROM raw)""")
    complete("landed", "raw", "scraped_at")
    complete("landed", "raw", "firehose_arrival_at", severity="warn")
    add("landed", "observed_at within 26 h", f"""(SELECT CASE WHEN max(
        CAST(TRY_CAST(scraped_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP))
        >= {ASOF} - INTERVAL 26 HOUR THEN 0 ELSE 1 END FROM raw)""")
    complete("staged", "stg", "property_id")
    within("staged", "stg", "dist_to_archives_km", 0, 100)
    accepted("staged", "stg", "value_zone", config.VALUE_ZONES)
    within("staged", "stg", "price_ksh", s.min_price, s.max_price)
    add("staged", "property_id unique", repeats_of("stg", "property_id"))
    add("enriched", "median > 0", count_of("enr", "NOT neighbourhood_median_ksh > 0"))
    accepted("enriched", "enr", "commute_tier", config.COMMUTE_TIERS)
    accepted("enriched", "enr", "location_segment", config.LOCATION_SEGMENTS)
    add("enriched", "is_sweet_spot accepted", count_of("enr", "is_sweet_spot NOT IN (TRUE, FALSE)"))
    accepted("enriched", "enr", "bedroom_label", config.BEDROOM_LABELS)
    add("enriched", "pct plausible",
        count_of("enr", "NOT price_vs_neighbourhood_median BETWEEN -100 AND 1000"))
    add("enriched", "bedroom_pricing", """(SELECT count(*) FROM (
        SELECT neighbourhood, bedroom_label, avg(price_ksh) AS mean FROM enr GROUP BY 1, 2) a
        JOIN (SELECT neighbourhood, avg(price_ksh) AS one FROM enr
              WHERE bedroom_label = '1 BR' GROUP BY 1) b
        ON a.neighbourhood IS NOT DISTINCT FROM b.neighbourhood
        WHERE a.bedroom_label IN ('3 BR', '4+ BR') AND mean < one * CAST(0.8 AS DOUBLE))""")
    add("enriched", "geographic_alignment", count_of("enr", """
        (commute_tier IN ('1 - Walking (0-2 km)', '2 - Short (2-5 km)')
          AND location_segment <> 'Core CBD / Inner Ring')
        OR (commute_tier = '5 - Far (15+ km)' AND location_segment = 'Core CBD / Inner Ring')"""))
    add("enriched", "neighbourhood_maths", count_of("enr", """
        (neighbourhood IS NOT NULL AND neighbourhood_median_ksh IS NULL)
        OR (neighbourhood_median_ksh IS NOT NULL AND price_vs_neighbourhood_median IS NULL)
        OR neighbourhood_median_ksh = 0"""))
    add("enriched", "orphan_medians",
        count_of("enr", "neighbourhood IS NOT NULL AND neighbourhood_median_ksh IS NULL"))
    add("enriched", "percentage_direction", count_of("enr", DIRECTION))
    add("enriched", "sweet_spot_rules", count_of("enr", SWEET))
    complete("fact", "fact", "property_id", "price_ksh")
    add("fact", "property_id unique", repeats_of("fact", "property_id"))
    add("fact", "property_id, scraped_date unique",
        repeats_of("fact", "property_id", "scraped_date"))
    add("fact", "neighbourhood has parent",
        count_of("fact", "neighbourhood NOT IN (SELECT neighbourhood FROM places)"))
    add("fact", "scraped_date has parent",
        count_of("fact", "scraped_date NOT IN (SELECT date_day FROM calendar)"))
    add("fact", "leakage", """(SELECT CASE WHEN (SELECT count(*) FROM fact) < (SELECT count(*)
        FROM enr WHERE neighbourhood IS NOT NULL AND scraped_date IS NOT NULL)
        THEN 1 ELSE 0 END)""")
    complete("calendar", "calendar", "date_day")
    add("calendar", "date_day unique", repeats_of("calendar", "date_day"))
    complete("places", "places", "neighbourhood")
    accepted("places", "places", "commute_tier", config.COMMUTE_TIERS)
    add("places", "neighbourhood unique", repeats_of("places", "neighbourhood"))
    complete("stats", "stats", "neighbourhood", "value_rank")
    add("stats", "neighbourhood unique", repeats_of("stats", "neighbourhood"))
    add("stats", "rank_one_benchmarks",
        f"(SELECT count(*) FROM ({RANK_ONE.format(source='stats')}))")
    complete(
        "finder", "finder", "neighbourhood", "overall_value_rank", "composite_score",
        "price_rank", "distance_rank", "consistency_rank", "verdict", "dist_to_archives_km",
        "value_zone", "median_rent_ksh", "avg_rent_ksh", "total_listings", "sweet_spot_pct",
    )
    for c in ("overall_value_rank", "price_rank", "distance_rank", "consistency_rank"):
        within("finder", "finder", c, 1)
    within("finder", "finder", "composite_score", 0)
    within("finder", "finder", "dist_to_archives_km", 0, 60)
    within("finder", "finder", "median_rent_ksh", s.min_price, s.max_price)
    within("finder", "finder", "avg_rent_ksh", s.min_price, s.max_price)
    within("finder", "finder", "affordability_index", 0)
    within("finder", "finder", "iqr_rent_ksh", 0)
    within("finder", "finder", "total_listings", s.min_support)
    within("finder", "finder", "sweet_spot_pct", 0, 100)
    accepted("finder", "finder", "verdict", config.VERDICTS)
    accepted("finder", "finder", "value_zone", config.VALUE_ZONES)
    add("finder", "neighbourhood unique", repeats_of("finder", "neighbourhood"))
    add("finder", "score_deviation", count_of("finder", f"abs(composite_score - {SCORE}) > 0.02"))
    add("finder", "rank_order", """(SELECT CASE WHEN
        (SELECT min(composite_score) FROM finder WHERE overall_value_rank = 1)
        > (SELECT min(composite_score) FROM finder WHERE overall_value_rank = 2)
        THEN 1 ELSE 0 END)""")
    add("finder", "verdict_contract", count_of("finder", """
        (verdict = 'Project Star' AND NOT (sweet_spot_pct >= 60 AND dist_to_archives_km <= 8))
        OR (verdict = 'Premium Location'
            AND NOT (dist_to_archives_km <= 5 AND median_rent_ksh >= 50000))"""))
    add("trends", "neighbourhood complete", count_of("fact", "neighbourhood IS NULL"))
    add("trends", "month_start complete", count_of("calendar", "month_start IS NULL"))
    complete("points", "points", "property_id", "dist_to_archives_km")
    add("points", "property_id unique", repeats_of("points", "property_id"))
    return over("points", " UNION ALL ".join(report_line(*line) for line in lines))


@query("q13_quality_report", full_report_sql())
def q13(spark, folder):
    asof = base.asof(spark, folder)
    built = warehouse.build(base.landed(spark, folder), asof)
    batch = spool(staging.batch_cleaned(built.landed, asof))
    return warehouse.quality_report(built, asof, batch=batch)
