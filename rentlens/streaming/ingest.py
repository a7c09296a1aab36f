"""Envelope stream to archive, history and landed table.

The consumers are separate queries, each with its own checkpoint, so one can fail
or lag without the other. Deliveries may repeat and batches may be replayed: file
sinks commit each batch once, and `foreachBatch` writes are keyed by query and batch: a
replayed batch replaces its own rows, and a query with a new checkpoint adds to what the
ones before it have stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rentlens.config import DEFAULTS, Settings
from rentlens.functions.dates import archive_partitions, expiry_seconds, now_utc
from rentlens.functions.text import first_non_empty
from rentlens.operators.dedupe import latest_per_key
from rentlens.operators.filters import split_required
from rentlens.operators.upsert import KeyedTable
from rentlens.plans.canonical import iso_utc
from rentlens.schema import CANONICAL, CANONICAL_COLUMNS, ENVELOPE
from rentlens.session import shuffles_released
from rentlens.sources import envelope
from rentlens.sources.tables import ARCHIVE_PARTITIONS, archive_schema

# Sequence numbers are decimal text of any length, so the longer one is later.
VERSION = ["_digits", "_seq"]
_VERSION_FIELDS = [T.StructField("_digits", T.IntegerType()), T.StructField("_seq", T.StringType())]
HISTORY_SCHEMA = T.StructType(
    [
        *CANONICAL.fields,
        T.StructField("scraped_date", T.StringType()),
        T.StructField("expires_at", T.LongType()),
        *_VERSION_FIELDS,
    ]
)
CURRENT_SCHEMA = T.StructType([*CANONICAL.fields, *_VERSION_FIELDS])
HISTORY_KEYS = ["property_id", "scraped_date"]


def accepted_records(
    records: DataFrame, stamp: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Ingestion: records with the required fields, stamped; and the rejects."""
    accepted, rejected = split_required(records)
    return (
        accepted.withColumn("ingested_at", iso_utc(stamp if stamp is not None else now_utc())),
        rejected,
    )


def received(
    requests: DataFrame, stamp: Column | None = None, payload: T.StructType = CANONICAL
) -> tuple[DataFrame, DataFrame]:
    """Requests (event_id, body, is_base64, seq, arrival) as envelopes of the records with
    all required fields, stamped; and the rejects (event_id, error). No body is an empty
    record."""
    body = F.coalesce(F.nullif("body", F.lit("")), F.lit("{}"))
    text = F.when(F.col("is_base64"), envelope.plain_text(body)).otherwise(body)
    # Exploding one element keeps the planner from parsing the body anew for each field.
    parsed = envelope.with_record(requests, text, payload).select(
        "event_id", "seq", "arrival", F.explode(F.array("record")).alias("record")
    )
    unread = parsed.filter("record IS NULL").select(
        "event_id", F.lit("Invalid JSON or Base64 encoding").alias("error")
    )
    records = parsed.filter("record IS NOT NULL").select("event_id", "seq", "arrival", "record.*")
    accepted, rejected = accepted_records(records, stamp)
    sent = envelope.wrap(
        accepted,
        F.to_json(F.struct(*payload.fieldNames())),
        F.col("event_id"), F.col("seq"), F.col("arrival"),
    )
    return sent, unread.unionByName(rejected.select("event_id", "error"))


def envelope_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(ENVELOPE)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def without_repeats(envelopes: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drops a delivery seen before within the delay; state is bounded by it."""
    return (
        envelopes.withColumn("arrival_ts", F.timestamp_seconds("arrival"))
        .withWatermark("arrival_ts", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def observed(envelopes: DataFrame, name: str, payload: T.StructType = CANONICAL) -> DataFrame:
    """`envelopes`, with the decodable and other records of each batch counted as `name`
    in the progress of the query that reads them."""
    known = envelope.decode(envelopes, payload).observe(
        name,
        F.count_if(F.col("record").isNotNull()).alias("records_ok"),
        F.count_if(F.col("record").isNull()).alias("records_error"),
    )
    return known.drop("record")


def start_archive(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    payload: T.StructType = CANONICAL,
    stamp: Column | None = None,
) -> StreamingQuery:
    """Valid records as compressed NDJSON by hour of processing time."""
    rows = envelope.valid_rows(envelope.decode(envelopes, payload))
    when = stamp if stamp is not None else now_utc()
    return (
        rows.withColumns(archive_partitions(when))
        .writeStream.format("json")
        .option("compression", "gzip")
        .partitionBy(*ARCHIVE_PARTITIONS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_dead_letters(
    envelopes: DataFrame, path: str, checkpoint: str, payload: T.StructType = CANONICAL
) -> StreamingQuery:
    """Undecodable records and the counts of each batch, kept by batch id. A batch
    without one valid record fails its query, and is read again at the next start."""

    def store(batch: DataFrame, batch_id: int, query: str) -> None:
        seen = Observation()
        decoded = envelope.decode(batch, payload).observe(
            seen,
            F.count_if(F.col("record").isNotNull()).alias("records_ok"),
            F.count_if(F.col("record").isNull()).alias("records_error"),
        )
        place = f"query={query}/batch_id={batch_id}"
        attempt = f"{path}-attempts/{uuid.uuid4().hex}"
        envelope.dead_letters(decoded).write.json(attempt)
        try:
            store_counts(batch.sparkSession, seen, f"{path}/counts/{place}")
        except envelope.AllRecordsFailed:
            delete(batch.sparkSession, attempt)
            raise
        move(batch.sparkSession, attempt, f"{path}/letters/{place}")

    return start_batches(envelopes, checkpoint, store)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = located(spark, path)
    fs.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Put a folder where another one may stand, of an earlier try at the same batch."""
    (fs, source), (_, target) = located(spark, path), located(spark, to)
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


def located(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def store_counts(spark: SparkSession, seen: Observation, path: str) -> None:
    """Keep what a batch counted while it was written; fail it if nothing was valid."""
    counts = {name: int(n or 0) for name, n in seen.get.items()}
    good, bad = counts.values()
    envelope.require_some_valid(good, bad)
    spark.createDataFrame([(good, bad)], [*counts]).coalesce(1).write.mode("overwrite").json(path)


def history_rows(valid: DataFrame, asof: Column, s: Settings = DEFAULTS) -> DataFrame:
    """Keyed, stamped rows; the last delivery of a key in the batch wins."""
    keyed = valid.filter(F.coalesce("property_id", F.lit("")) != "").select(
        *CANONICAL_COLUMNS,
        first_non_empty(F.col("scraped_at"), iso_utc(asof)).alias("scraped_date"),
        expiry_seconds(asof, s.expiry_days).alias("expires_at"),
        F.length("_seq").alias("_digits"),
        "_seq",
    )
    return latest_per_key(keyed, HISTORY_KEYS, VERSION)


def history_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, HISTORY_SCHEMA, HISTORY_KEYS, VERSION)


def current_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, CURRENT_SCHEMA, ["property_id"], VERSION)


def start_current(
    envelopes: DataFrame, path: str, checkpoint: str, s: Settings = DEFAULTS
) -> StreamingQuery:
    """The last delivery of each listing by its sequence number, in whatever order files,
    batches and restarts bring them. A batch keeps its own last rows; the table compares
    versions between batches, so the stream needs no state, and no delivery is too late."""
    table = current_table(envelopes.sparkSession, path)

    def store(batch: DataFrame, batch_id: int, query: str) -> None:
        rows = envelope.valid_rows(envelope.decode(batch)).filter(F.coalesce("property_id", F.lit("")) != "")
        numbered = rows.select(*CANONICAL_COLUMNS, F.length("_seq").alias("_digits"), "_seq")
        table.upsert(latest_per_key(numbered, ["property_id"], VERSION), f"{query}-{batch_id}")
        if len(table.commits()) > s.history_commits:
            table.compact()

    return start_batches(envelopes, checkpoint, store)


def start_history(
    envelopes: DataFrame,
    path: str,
    checkpoint: str,
    asof: Column | None = None,
    s: Settings = DEFAULTS,
) -> StreamingQuery:
    """One row per listing and observation; of deliveries of one key the later wins, by
    sequence number, in whichever batch it comes.

    Records without an id are skipped and counted. A batch that yields nothing at
    all fails, so that it is delivered again. When commits add up, old ones are folded
    into one, without the rows that have expired.
    """
    table = history_table(envelopes.sparkSession, path)
    when = asof if asof is not None else now_utc()

    def store(batch: DataFrame, batch_id: int, query: str) -> None:
        usable = F.coalesce(F.col("record.property_id"), F.lit("")) != ""
        seen = Observation()
        decoded = envelope.decode(batch).observe(
            seen, F.count_if(usable).alias("processed"), F.count_if(~usable).alias("failed")
        )
        attempt = table.stage(history_rows(envelope.valid_rows(decoded), when, s))
        try:
            counts = f"{path}_counts/query={query}/batch_id={batch_id}"
            store_counts(batch.sparkSession, seen, counts)
        except envelope.AllRecordsFailed:
            table.discard(attempt)
            raise
        table.commit(attempt, f"{query}-{batch_id}")
        if len(table.commits()) > s.history_commits:
            table.compact(where=live_at(when))

    return start_batches(envelopes, checkpoint, store)


def start_batches(
    stream: DataFrame, checkpoint: str, store: Callable[[DataFrame, int, str], None]
) -> StreamingQuery:
    """`store` gets each batch, its number, and the id that the query keeps in its
    checkpoint: batch numbers start anew with a new checkpoint, ids do not repeat."""
    names: list[str] = []

    def keyed(batch: DataFrame, batch_id: int) -> None:
        if not names:
            names.append(batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"])
        # The batch has a session of its own, so no other query is touched.
        with shuffles_released(batch.sparkSession):
            store(batch, batch_id, names[0])

    return (
        stream.writeStream.foreachBatch(keyed)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def live_at(asof: Column) -> Column:
    return F.col("expires_at") > F.unix_timestamp(asof.cast("timestamp"))


def unexpired(history: DataFrame, asof: Column) -> DataFrame:
    return history.filter(live_at(asof))


def latest_state(history: DataFrame) -> DataFrame:
    """The newest observation of each listing. `max_by` keeps partial maxima."""
    columns = [c for c in history.columns if c != "property_id"]
    newest = history.groupBy("property_id").agg(
        F.max_by(F.struct(*columns), F.struct("scraped_date", *columns)).alias("_newest")
    )
    return newest.select("property_id", "_newest.*")


def start_landing(
    spark: SparkSession,
    archive: str,
    landed: str,
    checkpoint: str,
    payload: T.StructType = CANONICAL,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Each new archive file, mapped to the table's columns and appended once."""
    rows = (
        spark.readStream.schema(archive_schema(payload))
        .option("maxFilesPerTrigger", files_per_batch)
        .json(archive)
    )
    return (
        rows.select(*payload.fieldNames(), now_utc().alias("firehose_arrival_at"))
        .writeStream.format("parquet")
        .option("path", landed)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
