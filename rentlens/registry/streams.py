"""Streaming (ST), stream sinks (S2, S3, S6), counters (A18) and Q12.

Each query writes the deliveries derived from the tables as envelope files, runs
the streaming job over them to the end, and returns what its sink holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.plans import staging
from rentlens.registry import base
from rentlens.registry.base import query
from rentlens.registry.layers import NEWEST, over
from rentlens.registry.sources import CANON_SQL, ENVELOPE_BAD, envelopes, scratch
from rentlens.schema import CANONICAL_COLUMNS, ENVELOPE, LANDED
from rentlens.session import shuffles_released
from rentlens.sources import driver_tables, tables
from rentlens.streaming import buffered, ingest, measures

GOOD = f"(SELECT * FROM raw WHERE NOT ({ENVELOPE_BAD}))"


#: Rows of one file: compressed files are not split, so a large one would be a long task.
FILE_ROWS = 200_000


def stored(spark, rows: DataFrame, path: str, file_rows: int = FILE_ROWS) -> str:
    """Envelopes added to a folder, as compressed files of bounded size."""
    with shuffles_released(spark):
        rows.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", file_rows).json(path)
    return path


def delivered(spark, folder, repeats: bool = False) -> DataFrame:
    """The envelope stream; with `repeats`, some deliveries come twice."""
    rows = envelopes(spark, folder)
    path = stored(spark, with_repeats(rows) if repeats else rows, scratch(spark, "envelopes"))
    return ingest.envelope_stream(spark, path)


def with_repeats(rows: DataFrame) -> DataFrame:
    """A tenth of the deliveries again, a minute later."""
    again = rows.filter(F.col("seq").cast("long") % 10 == 3)
    return rows.unionByName(again.withColumn("arrival", F.col("arrival") + 60))


def in_turns(spark, rows: DataFrame, turns) -> Iterator[DataFrame]:
    """The stream of one folder to which thirds of the deliveries, by sequence number, are
    added one after the other, many files at once. It goes after the last turn."""
    path, seq = scratch(spark, "turns"), F.col("seq").cast("long")
    with shuffles_released(spark):
        third = F.floor(seq / rows.agg(F.max(seq) / 3 + 1).first()[0])
    for i in turns:
        yield ingest.envelope_stream(spark, stored(spark, rows.filter(third == i), path))
    ingest.delete(spark, path)


def finish(*running) -> None:
    for q in running:
        q.awaitTermination()
        if q.exception():
            raise q.exception()


def stamp():
    return F.lit("2026-03-04 05:06:07").cast("timestamp_ntz")


@query(
    "s2_incremental_load",
    over("raw", f"SELECT {CANON_SQL} FROM {GOOD}"),
)
def s2(spark, folder):
    """Archive files appended once each, though the load is started twice."""
    archive, landed = scratch(spark, "archive"), scratch(spark, "landed")
    marks = scratch(spark, "checkpoints")
    finish(ingest.start_archive(delivered(spark, folder), archive, f"{marks}/a", stamp=stamp()))
    for _ in range(2):
        finish(ingest.start_landing(spark, archive, landed, f"{marks}/l"))
    return spark.read.schema(LANDED).parquet(landed).select(CANONICAL_COLUMNS)


@query(
    "s3_archive_sink",
    over(
        "raw",
        f"""SELECT property_id, price_ksh, CAST(arrival_seq AS VARCHAR) AS _seq,
              '2026' AS year, '03' AS month, '04' AS day, '05' AS hour FROM {GOOD}""",
    ),
)
def s3(spark, folder):
    archive, marks = scratch(spark, "archive"), scratch(spark, "checkpoints")
    finish(ingest.start_archive(delivered(spark, folder), archive, marks, stamp=stamp()))
    return tables.read_archive(spark, archive).select(
        "property_id", "price_ksh", "_seq", *tables.ARCHIVE_PARTITIONS
    )


HISTORY = f"""SELECT property_id, scraped_at AS scraped_date, price_ksh, price_raw,
    epoch(TIMESTAMP '2026-03-04 05:06:07')::BIGINT + 90 * 86400 AS expires_at
  FROM {GOOD} QUALIFY row_number() OVER (PARTITION BY property_id, scraped_at
    ORDER BY length(CAST(arrival_seq AS VARCHAR)) DESC, CAST(arrival_seq AS VARCHAR) DESC) = 1"""
HISTORY_COLUMNS = ["property_id", "scraped_date", "price_ksh", "price_raw", "expires_at"]


def run_history(spark, folder):
    path, marks = scratch(spark, "history"), scratch(spark, "checkpoints")
    finish(
        ingest.start_history(delivered(spark, folder, repeats=True), path, marks, asof=stamp())
    )
    return path


@query("s6_history_upsert", over("raw", HISTORY))
def s6(spark, folder):
    path = run_history(spark, folder)
    return ingest.history_table(spark, path).read().select(HISTORY_COLUMNS)


@query(
    "s6_history_latest",
    over(
        "raw",
        f"""SELECT property_id, scraped_date FROM ({HISTORY})
            QUALIFY row_number() OVER (PARTITION BY property_id ORDER BY scraped_date DESC) = 1""",
    ),
)
def s6_latest(spark, folder):
    """Unexpired history, reduced to the newest observation of each listing."""
    path = run_history(spark, folder)
    live = ingest.unexpired(ingest.history_table(spark, path).read(), stamp())
    return ingest.latest_state(live).select("property_id", "scraped_date")


@query(
    "a18_batch_counters",
    over(
        "raw",
        f"""SELECT (SELECT CAST(sum(CASE WHEN arrival_seq % 10 = 3 THEN 2 ELSE 1 END) AS BIGINT)
                    FROM {GOOD}) AS processed,
              (SELECT CAST(sum(CASE WHEN arrival_seq % 10 = 3 THEN 2 ELSE 1 END) AS BIGINT)
               FROM raw WHERE {ENVELOPE_BAD}) AS failed FROM (SELECT 1)""",
    ),
)
def a18(spark, folder):
    path = run_history(spark, folder)
    counts = spark.read.schema("processed long, failed long").json(f"{path}_counts")
    return counts.agg(
        F.sum("processed").alias("processed"), F.sum("failed").alias("failed")
    )


@query(
    "a18_measures_of_batches",
    over(
        "raw",
        f"""SELECT (SELECT count(*) FROM {GOOD}) AS records_ok,
              (SELECT count(*) FROM raw WHERE {ENVELOPE_BAD}) AS records_error,
              (SELECT count(*) FROM {GOOD}) + (SELECT count(*) FROM raw WHERE {ENVELOPE_BAD}) AS input_rows,
              0 AS skipped FROM (SELECT 1)""",
    ),
)
def a18_measures(spark, folder):
    """What a listener tells of the batches of a stream, by what the stream observes."""
    path, at = scratch(spark, "measures"), scratch(spark, "archive")
    seen = ingest.observed(delivered(spark, folder), "deliveries")
    listener = measures.Measures(spark, path)
    spark.streams.addListener(listener)
    try:
        running = ingest.start_archive(seen, at, f"{at}-checkpoint", stamp=stamp())
        finish(running)
        listener.wait(str(running.runId))
    finally:
        spark.streams.removeListener(listener)
    batches = measures.progress(spark, path)
    return batches.agg(
        measures.observed_total("deliveries", "records_ok").alias("records_ok"),
        measures.observed_total("deliveries", "records_error").alias("records_error"),
        F.sum("input_rows").alias("input_rows"),
        (F.max("batch_id") - F.min("batch_id") + 1 - F.count("*")).alias("skipped"),
    )


@query(
    "st1_two_consumers",
    over(
        "raw",
        f"""SELECT 'archive' AS consumer, count(*) AS n FROM {GOOD}
            UNION ALL SELECT 'history', count(*) FROM ({HISTORY})""",
    ),
)
def st1(spark, folder):
    """Two queries over one stream, each with its own checkpoint."""
    path = stored(spark, envelopes(spark, folder), scratch(spark, "envelopes"))
    stream = ingest.envelope_stream(spark, path)
    archive, history = scratch(spark, "archive"), scratch(spark, "history")
    marks = scratch(spark, "checkpoints")
    finish(
        ingest.start_archive(stream, archive, f"{marks}/a", stamp=stamp()),
        ingest.start_history(stream, history, f"{marks}/h", asof=stamp()),
    )
    ingest.delete(spark, path)
    counts = {
        "archive": tables.read_archive(spark, archive),
        "history": ingest.history_table(spark, history).read(),
    }
    counted = [
        rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("consumer"), "n")
        for name, rows in counts.items()
    ]
    return counted[0].unionByName(counted[1])


@query(
    "st2_repeats_dropped",
    over(
        "raw",
        """SELECT 'shard-' || (arrival_seq % 4) || ':' || arrival_seq AS event_id,
             CAST(arrival_seq AS VARCHAR) AS seq FROM raw""",
    ),
)
def st2(spark, folder):
    """Repeats that arrive within the delay are dropped while streaming; a key leaves the
    state an hour after it was seen."""
    stream = ingest.without_repeats(delivered(spark, folder, repeats=True))
    path, marks = scratch(spark, "unique"), scratch(spark, "checkpoints")
    finish(
        stream.select("event_id", "seq")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", marks)
        .trigger(availableNow=True)
        .start()
    )
    return spark.read.schema("event_id string, seq string").parquet(path)


@query(
    "st3_last_per_key",
    over(
        "raw",
        f"""SELECT property_id, price_ksh, _seq FROM (
             SELECT property_id, price_ksh, arrival_seq, CAST(arrival_seq AS VARCHAR) AS _seq
             FROM {GOOD} QUALIFY row_number() OVER
               (PARTITION BY property_id ORDER BY arrival_seq DESC) = 1)""",
    ),
)
def st3(spark, folder):
    """Batches come latest first, each after a restart from the checkpoint, and repeat
    deliveries; the order within a key comes from the sequence number."""
    path, marks = scratch(spark, "current"), scratch(spark, "checkpoints")
    for stream in in_turns(spark, with_repeats(envelopes(spark, folder)), (2, 0, 1)):
        finish(ingest.start_current(stream, path, marks))
    return ingest.current_table(spark, path).read().select("property_id", "price_ksh", "_seq")


@query(
    "st4_ingestion_stamp",
    over(
        "raw",
        """SELECT arrival_seq, '2026-03-04T05:06:07.000000+00:00' AS ingested_at
           FROM raw WHERE coalesce(location_raw, '') <> ''""",
    ),
)
def st4(spark, folder):
    accepted, _ = ingest.accepted_records(base.raw(spark, folder), stamp())
    return accepted.select("arrival_seq", "ingested_at")


@query("st5_replayed_batch", over("raw", HISTORY))
def st5(spark, folder):
    """The files stored by two queries, each with a checkpoint and a split into batches
    of its own: batch numbers start anew, and no rows are lost."""
    path, marks = scratch(spark, "history"), scratch(spark, "checkpoints")
    whole = stored(spark, with_repeats(envelopes(spark, folder)), scratch(spark, "envelopes"))
    finish(ingest.start_history(ingest.envelope_stream(spark, whole), path, f"{marks}/whole", asof=stamp()))
    ingest.delete(spark, whole)
    for part in in_turns(spark, with_repeats(envelopes(spark, folder)), (0, 1, 2)):
        finish(ingest.start_history(part, path, f"{marks}/parts", asof=stamp()))
    return ingest.history_table(spark, path).read().select(HISTORY_COLUMNS)


@query(
    "st6_small_batches",
    over("raw", f"SELECT property_id, price_ksh, CAST(arrival_seq AS VARCHAR) AS _seq FROM {GOOD}"),
)
def st6(spark, folder):
    """Several micro-batches of a few files each, buffered to the archive. Files are cut by
    their rows, so no envelope is shuffled; six at least, and a third of them in a batch."""
    rows, n = envelopes(spark, folder), driver_tables.table(spark, folder, "orders").count()
    path = stored(spark, rows, scratch(spark, "envelopes"), min(FILE_ROWS, max(1, math.ceil(n / 6))))
    files = len(spark.read.schema(ENVELOPE).json(path).inputFiles())
    stream = ingest.envelope_stream(spark, path, files_per_batch=max(2, files // 3))
    archive, marks = scratch(spark, "archive"), scratch(spark, "checkpoints")
    finish(ingest.start_archive(stream, archive, marks, stamp=stamp()))
    return tables.read_archive(spark, archive).select("property_id", "price_ksh", "_seq")


@query(
    "st6_held_until_large",
    over("raw", f"SELECT property_id, price_ksh, CAST(arrival_seq AS VARCHAR) AS _seq FROM {GOOD}"),
)
def st6_held(spark, folder):
    """Batches with a restart between them, held until they make large files; what waits
    at the end is drained."""
    archive, marks = scratch(spark, "archive"), scratch(spark, "checkpoints")
    for stream in in_turns(spark, envelopes(spark, folder), (0, 1, 2)):
        finish(buffered.start_buffered(stream, archive, marks, stamp=stamp()))
    buffered.drain(spark, archive)
    return tables.read_archive(spark, archive).select("property_id", "price_ksh", "_seq")


# Requests that are no JSON, no base64, or lack the price; and records spoilt on the way.
NO_JSON, NO_BASE64 = "arrival_seq % 97 = 5", "arrival_seq % 2 = 0 AND arrival_seq % 101 = 7"
NO_PRICE, SPOILT = "arrival_seq % 89 = 3", "arrival_seq % 103 = 9"
RECEIVED = f"(SELECT * FROM raw WHERE NOT ({NO_JSON}) AND NOT ({NO_BASE64}) AND NOT ({NO_PRICE}))"
ARRIVED = f"(SELECT * FROM {RECEIVED} WHERE NOT ({SPOILT}))"
EVENT_ID = "'shard-' || (arrival_seq % 4) || ':' || arrival_seq"


def requests(spark, folder) -> DataFrame:
    """The deliveries as posted bodies, every other one in base64."""
    rows, seq = base.raw(spark, folder), F.col("arrival_seq")
    price = F.when(~F.expr(NO_PRICE), F.col("price_raw")).alias("price_raw")
    fields = [price if c == "price_raw" else F.col(c) for c in CANONICAL_COLUMNS if c != "ingested_at"]
    body = F.when(F.expr(NO_JSON), F.lit('{"property_id": "cut of')).otherwise(F.to_json(F.struct(*fields)))
    coded = F.when(F.expr(NO_BASE64), F.lit("%% no base64 %%")).otherwise(F.base64(body.cast("binary")))
    return rows.select(
        F.concat(F.lit("shard-"), (seq % 4).cast("string"), F.lit(":"), seq.cast("string")).alias("event_id"),
        F.when(seq % 2 == 0, coded).otherwise(body).alias("body"),
        (seq % 2 == 0).alias("is_base64"),
        seq.cast("string").alias("seq"),
        F.unix_timestamp(F.col("firehose_arrival_at").cast("timestamp")).cast("double").alias("arrival"),
    )


def whole_flow(spark, folder) -> dict[str, str]:
    """Requests to envelopes; envelopes to archive, history and dead letters; archive to
    the landed table. Returns where each sink lies."""
    sent, _ = ingest.received(requests(spark, folder), stamp())
    spoilt = F.expr(SPOILT.replace("arrival_seq", "CAST(seq AS BIGINT)"))
    rows = with_repeats(sent.withColumn("data", F.when(spoilt, F.lit("%%")).otherwise(F.col("data"))))
    path = stored(spark, rows, scratch(spark, "envelopes"))
    stream = ingest.envelope_stream(spark, path)
    at = {name: scratch(spark, name) for name in ("archive", "landed", "history", "letters")}
    marks = scratch(spark, "checkpoints")
    finish(
        ingest.start_archive(stream, at["archive"], f"{marks}/a", stamp=stamp()),
        ingest.start_history(stream, at["history"], f"{marks}/h", asof=stamp()),
        ingest.start_dead_letters(stream, at["letters"], f"{marks}/d"),
    )
    ingest.delete(spark, path)
    finish(ingest.start_landing(spark, at["archive"], at["landed"], f"{marks}/l"))
    return at


@query(
    "q12_rejected_requests",
    over(
        "raw",
        f"""SELECT {EVENT_ID} AS event_id, CASE WHEN {NO_JSON} OR {NO_BASE64}
              THEN 'Invalid JSON or Base64 encoding'
              ELSE 'Missing required fields: price_raw' END AS error
            FROM raw WHERE {NO_JSON} OR ({NO_BASE64}) OR {NO_PRICE}""",
    ),
)
def q12_rejected(spark, folder):
    return ingest.received(requests(spark, folder), stamp())[1]


@query(
    "q12_history",
    over("raw", HISTORY.replace(GOOD, ARRIVED)),
)
def q12_history(spark, folder):
    at = whole_flow(spark, folder)
    return ingest.history_table(spark, at["history"]).read().select(HISTORY_COLUMNS)


@query(
    "q12_dead_letters",
    over(
        "raw",
        f"""SELECT {EVENT_ID} AS event_id, CASE WHEN arrival_seq % 10 = 3 THEN 2 ELSE 1 END AS times
            FROM {RECEIVED} WHERE {SPOILT}""",
    ),
)
def q12_letters(spark, folder):
    at = whole_flow(spark, folder)
    letters = spark.read.schema(ENVELOPE).json(f"{at['letters']}/letters")
    return letters.groupBy("event_id").agg(F.count("*").cast("int").alias("times"))


@query(
    "q12_stream_to_staging",
    over(
        "raw",
        f"""SELECT property_id, price_ksh, value_zone, neighbourhood, ingested_at FROM (
            SELECT property_id, price_ksh, value_zone, '2026-03-04T05:06:07.000000+00:00' AS ingested_at,
                   upper(substr(trim(neighbourhood), 1, 1)) || lower(substr(trim(neighbourhood), 2))
                     AS neighbourhood FROM (
              SELECT *, CASE WHEN dist_to_archives_km IS NULL THEN 'Unknown'
                 WHEN price_ksh >= 80000 AND dist_to_archives_km <= 5.0 THEN 'Premium'
                 WHEN price_ksh < 50000 AND dist_to_archives_km <= 8.0 THEN 'Sweet Spot'
                 WHEN dist_to_archives_km > 15.0 THEN 'Commuter' ELSE 'Mid-range' END AS value_zone
              FROM {ARRIVED} WHERE price_ksh BETWEEN 3000 AND 2000000
              QUALIFY row_number() OVER (PARTITION BY property_id ORDER BY {NEWEST}) = 1))""",
    ),
)
def q12(spark, folder):
    """One landing run stamps all its rows alike, and so does ingestion here, so content
    decides which delivery is newest."""
    at = whole_flow(spark, folder)
    staged = staging.staged_listings(spark.read.schema(LANDED).parquet(at["landed"]))
    return staged.select("property_id", "price_ksh", "value_zone", "neighbourhood", "ingested_at")
