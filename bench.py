"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up, then BENCH_RUNS times; the median counts. A run
builds the query, spooled steps included, and reads every row and column of its
result.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from rentlens.registry import QUERIES
from rentlens.session import build

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = [
    "q1_staging",
    "q2_enriched",
    "q3_date_dimension",
    "q4_neighbourhood_dimension",
    "q5_listings_fact",
    "q6_neighbourhood_stats",
    "q7_value_ranking",
    "q8_rent_trends",
    "q9_price_points",
    "q10_batch_job",
    "q11_canonical_from_cards",
    "q12_stream_to_staging",
    "q13_quality_report",
]


def seconds(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build("bench", CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name)
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
