"""Scans, sources and sinks (S), the batch job (Q10) and card ingestion (Q11)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.operators import resolve
from rentlens.operators.spool import spool_folder
from rentlens.operators.upsert import KeyedTable
from rentlens.plans import batch_job, canonical, staging
from rentlens.registry import base
from rentlens.registry.base import query
from rentlens.registry.filters import STAGE, TARGET
from rentlens.registry.joins import NAMES_SQL, cache_rows, estates, lookup_rows
from rentlens.registry.layers import CLEAN, over, vincenty_sql
from rentlens.schema import CANONICAL, CANONICAL_COLUMNS
from rentlens.sources import cards, envelope, tables
from rentlens.sources.driver_tables import table
from rentlens.sources.gazetteer import PLACES, gazetteer


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for what a query has to write before it can read it. It goes with
    what the application spooled."""
    return f"{spool_folder(spark)}/registry/{name}-{uuid.uuid4().hex}"


def canonical_rows(spark, folder) -> DataFrame:
    return base.raw(spark, folder).select(*CANONICAL_COLUMNS, "firehose_arrival_at", "arrival_seq")


CANON_SQL = ", ".join(CANONICAL_COLUMNS)


@query(
    "s1_archive_scan",
    over(
        "raw",
        f"""SELECT {CANON_SQL}, 'batch' AS _shard, CAST(arrival_seq AS VARCHAR) AS _seq,
              epoch(firehose_arrival_at) AS _arrival,
              strftime(date_trunc('year', firehose_arrival_at), '%Y') AS year,
              '01' AS month, '01' AS day, '00' AS hour
            FROM raw WHERE firehose_arrival_at >= TIMESTAMP '1997-01-01'""",
    ),
)
def s1(spark, folder):
    """Written by year of arrival, read back with the older years pruned."""
    path = scratch(spark, "archive")
    arrival = F.col("firehose_arrival_at")
    rows = canonical_rows(spark, folder).select(
        *CANONICAL_COLUMNS,
        F.lit("batch").alias("_shard"),
        F.col("arrival_seq").cast("string").alias("_seq"),
        F.unix_timestamp(arrival.cast("timestamp")).cast("double").alias("_arrival"),
        F.date_trunc("year", arrival).alias("_stamp"),
    )
    tables.write_archive(
        rows.select(CANONICAL_COLUMNS + envelope.METADATA + ["_stamp"]),
        path,
        F.col("_stamp"),
        files_per_hour=2,
    )
    return tables.read_archive(spark, path).filter(F.col("year") >= "1997")


ENVELOPE_BAD = "arrival_seq % 97 = 5 OR arrival_seq % 101 = 7"


def envelopes(spark, folder) -> DataFrame:
    """The deliveries in transport form; some not base64, some not JSON."""
    rows = canonical_rows(spark, folder)
    seq = F.col("arrival_seq")
    wrapped = envelope.wrap(
        rows,
        F.to_json(F.struct(*CANONICAL_COLUMNS)),
        F.concat(
            F.lit("shard-"), (seq % 4).cast("string"), F.lit(":"), seq.cast("string")
        ),
        seq.cast("string"),
        F.unix_timestamp(F.col("firehose_arrival_at").cast("timestamp")).cast("double"),
    )
    number = F.col("seq").cast("long")
    return wrapped.withColumn(
        "data",
        F.when(number % 97 == 5, F.lit("%% not base64 %%"))
        .when(number % 101 == 7, F.base64(F.lit('{"property_id": "cut of').cast("binary")))
        .otherwise(F.col("data")),
    )


@query(
    "s4_envelope_decode",
    over(
        "raw",
        f"""SELECT {CANON_SQL}, 'shard-' || (arrival_seq % 4) AS _shard,
              CAST(arrival_seq AS VARCHAR) AS _seq, epoch(firehose_arrival_at) AS _arrival
            FROM raw WHERE NOT ({ENVELOPE_BAD})""",
    ),
)
def s4(spark, folder):
    return envelope.valid_rows(envelope.decode(envelopes(spark, folder)))


@query(
    "s5_dead_letters",
    over(
        "raw",
        f"""SELECT 'shard-' || (arrival_seq % 4) || ':' || arrival_seq AS event_id,
              CAST(arrival_seq AS VARCHAR) AS seq FROM raw WHERE {ENVELOPE_BAD}""",
    ),
)
def s5(spark, folder):
    return envelope.dead_letters(envelope.decode(envelopes(spark, folder))).select(
        "event_id", "seq"
    )


@query(
    "s5_delivery_counts",
    over(
        "raw",
        f"""SELECT count(*) FILTER (NOT ({ENVELOPE_BAD})) AS records_ok,
              count(*) FILTER ({ENVELOPE_BAD}) AS records_error FROM raw""",
    ),
)
def s5_counts(spark, folder):
    return envelope.delivery_counts(envelope.decode(envelopes(spark, folder)))


@query(
    "s7_latest_state",
    over(
        "raw",
        """SELECT property_id, trim(neighbourhood) AS neighbourhood, price_ksh FROM (
             SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY property_id
               ORDER BY firehose_arrival_at DESC, arrival_seq DESC) = 1)
           WHERE trim(neighbourhood) = 'nation_3'""",
    ),
)
def s7(spark, folder):
    """Latest price of every listing of one neighbourhood."""
    latest = (
        base.raw(spark, folder)
        .groupBy("property_id")
        .agg(
            F.max_by(
                F.struct(F.trim("neighbourhood").alias("neighbourhood"), "price_ksh"),
                F.struct("firehose_arrival_at", "arrival_seq"),
            ).alias("state")
        )
    )
    return latest.select("property_id", "state.*").filter("neighbourhood = 'nation_3'")


def landing_split(spark, folder):
    rows = canonical_rows(spark, folder)
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return rows.filter(F.col("firehose_arrival_at") < cut), rows.filter(
        F.col("firehose_arrival_at") >= cut
    )


@query(
    "s8_staged_upsert",
    over(
        "raw",
        f"""SELECT {CANON_SQL} FROM {TARGET} t
            WHERE NOT EXISTS (SELECT 1 FROM {STAGE} s WHERE s.property_id = t.property_id)
            UNION ALL SELECT {CANON_SQL} FROM {STAGE}""",
    ),
)
def s8(spark, folder):
    """Two upserts into a stored table, the second one run twice."""
    before, after = landing_split(spark, folder)
    stored = KeyedTable(spark, scratch(spark, "keyed"), CANONICAL, ["property_id"])
    stored.upsert(before, 1)
    stored.upsert(after, 2)
    stored.upsert(after, 2)
    return stored.read()


@query(
    "s9_json_array_files",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, 'KSh ' || o_custkey AS price, o_orderstatus AS title FROM orders",
)
def s9(spark, folder):
    """Files that each hold one JSON array of up to 5,000 records."""
    path = scratch(spark, "arrays")
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("KSh "), F.col("o_custkey").cast("string")).alias("price"),
        F.col("o_orderstatus").alias("title"),
    )
    orders = table(spark, folder, "orders")
    # Order keys are unique, so a range of 5,000 keys bounds each array. A file holds one
    # array, and all files lie in one folder.
    chunk = F.floor(F.col("o_orderkey") / 5000)
    arrays = orders.groupBy(chunk.alias("chunk")).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_records(spark, path).select("id", "price", "title")


@query(
    "s10_gazetteer",
    f"""SELECT o_orderkey, name, lat, lon FROM orders JOIN {NAMES_SQL}
        ON o_custkey % {len(PLACES)} = pos""",
)
def s10(spark, folder):
    numbered = spark.createDataFrame(
        [(i, name) for i, (name, _, _) in enumerate(PLACES)], "pos long, name string"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    named = orders.join(numbered, F.col("o_custkey") % len(PLACES) == F.col("pos"))
    return named.join(gazetteer(spark), "name").select("o_orderkey", "name", "lat", "lon")


@query(
    "s11_cache_append",
    """SELECT n_name || ' Estate' AS raw_string,
         upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS matched_name,
         n_nationkey / -100e0 AS lat FROM nation WHERE n_nationkey % 3 <> 0
       UNION ALL SELECT lower(n_name || ' Estate'), 'stale', n_nationkey / -100e0
       FROM nation WHERE n_nationkey % 3 <> 0
       UNION ALL SELECT DISTINCT CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) || ' ESTATE'
           ELSE n_name || ' Estate' END, 'Area ' || n_nationkey, n_nationkey / -200e0
       FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 6 = 0""",
)
def s11(spark, folder):
    """The cache after a batch: what it held, and what the batch resolved."""
    path = scratch(spark, "cache")
    tables.append_lookup(cache_rows(spark, folder), path)
    cache = tables.read_lookup(spark, path)
    texts = resolve.distinct_texts(estates(spark, folder))
    resolved = resolve.resolve_texts(texts, cache, lookup_rows(spark, folder))
    tables.append_lookup(resolve.new_cache_rows(resolved), path)
    return tables.read_lookup(spark, path).select("raw_string", "matched_name", "lat")


def card_pages(spark, folder) -> DataFrame:
    """Pages of up to 20 cards built from orders, beside the stored pages."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("o_orderkey")
    number = key.cast("string")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    href = F.when(key % 4 == 0, text("https://elsewhere.example/", number)).otherwise(
        text("/listing/", number)
    )
    place = F.when(key % 7 == 0, F.lit("")).otherwise(
        text('<div class="grey text-sm"> ', F.col("n_name"), " Estate </div>")
    )
    price = F.when(key % 9 == 0, F.lit("<p>Price on call</p>")).otherwise(
        text(
            "<p> KSh ",
            F.format_number(F.floor(F.col("o_totalprice") / 4), 0),
            " per month </p>",
        )
    )
    card = text(
        F.when(key % 2 == 0, F.lit('<div class="listing-card">')).otherwise(
            F.lit('<div class="relative shadowed-box"><img src="x.png">')
        ),
        '<a href="', href, '"><h2>Airy <b>', (key % 5).cast("string"), "</b> Bedroom &amp; garden</h2></a>",
        place, price,
        '<span class="feature-label">Parking</span><span class="feature-label">',
        (key % 3).cast("string"), " Bathrooms</span></div>",
    )
    # Pages are slow to parse for their size, so their number of parts is fixed here.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = (
        rows.select(F.floor(key / 20).alias("page_id"), F.struct(key, card.alias("card")).alias("c"))
        .repartition(tasks, "page_id")
        .groupBy("page_id")
        # Order keys are unique, so a page has 20 cards at most.
        .agg(F.array_sort(F.collect_list("c")).alias("cs"))
        .select(
            "page_id",
            F.concat(
                F.lit("<html><body><nav>KSh</nav>"),
                F.array_join("cs.card", "\n"),
                F.lit("</body></html>"),
            ).alias("html"),
        )
    )
    stored = table(spark, folder, "pages").select((-F.col("page_id") - 1).alias("page_id"), "html")
    return made.unionByName(stored)


CARDS = """cards AS (SELECT o_orderkey // 20 AS page_id,
    'Airy' || (o_orderkey % 5) || 'Bedroom & garden' AS title,
    'KSh ' || format('{:,}', CAST(floor(o_totalprice / 4) AS BIGINT)) || ' per month' AS price,
    CAST(floor(o_totalprice / 4) AS INT) AS price_ksh,
    CASE WHEN o_orderkey % 7 = 0 THEN 'Nairobi' ELSE n_name || ' Estate' END AS location,
    CASE WHEN o_orderkey % 4 = 0 THEN 'https://elsewhere.example/' || o_orderkey
         ELSE 'https://www.buyrentkenya.com/listing/' || o_orderkey END AS url,
    CAST(o_orderkey % 3 AS INT) AS card_bathrooms, CAST(o_orderkey % 5 AS INT) AS beds,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE n_nationkey END AS nkey, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderkey % 9 <> 0)"""


@query(
    "s12_listing_cards",
    f"WITH {CARDS} SELECT page_id, title, price, location, url, card_bathrooms FROM cards",
)
def s12(spark, folder):
    return cards.listing_cards(card_pages(spark, folder)).drop("position")


@query(
    "f13_bathroom_parser",
    f"WITH {CARDS} SELECT card_bathrooms, count(*) AS cards FROM cards GROUP BY 1",
)
def f13(spark, folder):
    """Counts by the bathrooms read from the tagged spans of each card."""
    found = cards.listing_cards(card_pages(spark, folder))
    return found.groupBy("card_bathrooms").agg(F.count("*").alias("cards"))


@query(
    "q11_canonical_from_cards",
    f"""WITH {CARDS} SELECT 'brk-' || substr(md5(url), 1, 12) AS property_id, url AS source_url,
          title, location AS location_raw, price AS price_raw, price_ksh,
          beds AS bedrooms, card_bathrooms AS bathrooms, 'Apartment' AS property_type,
          CASE WHEN nkey % 3 <> 0 THEN upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2))
               WHEN nkey % 6 = 0 THEN 'Area ' || nkey ELSE 'Unknown' END AS neighbourhood,
          CASE WHEN nkey % 3 <> 0 THEN nkey / -100e0 WHEN nkey % 6 = 0 THEN nkey / -200e0 END
            AS latitude
        FROM cards""",
)
def q11(spark, folder):
    """Cards to canonical listings; the geocoder extract knows no 'Nairobi'."""
    found = cards.listing_cards(card_pages(spark, folder))
    listings = canonical.canonical_listings(
        found, cache_rows(spark, folder), lookup_rows(spark, folder)
    )
    return listings.drop("scraped_at", "longitude", "dist_to_archives_km")


@query(
    "q11_distances",
    vincenty_sql(
        f"""(WITH {CARDS} SELECT 'brk-' || substr(md5(url), 1, 12) AS property_id,
          CASE WHEN nkey % 3 <> 0 THEN nkey / -100e0 WHEN nkey % 6 = 0 THEN nkey / -200e0 END AS lat,
          CASE WHEN nkey % 3 <> 0 THEN nkey + 36.5e0 WHEN nkey % 6 = 0 THEN nkey + 36.0e0 END AS lon
        FROM cards)""",
        "property_id, lon AS longitude",
        "dist_to_archives_km",
    ),
)
def q11_distances(spark, folder):
    """The same listings with their distances."""
    found = cards.listing_cards(card_pages(spark, folder))
    listings = canonical.canonical_listings(
        found, cache_rows(spark, folder), lookup_rows(spark, folder)
    )
    return listings.select("property_id", "longitude", "dist_to_archives_km")


@query(
    "s13_view_and_table",
    """SELECT 'view' AS kind, o_orderstatus, count(*) AS n FROM orders GROUP BY 2
       UNION ALL SELECT 'table', o_orderstatus, count(*) FROM orders GROUP BY 2""",
)
def s13(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    counts = [
        tables.publish(
            orders, f"orders_as_{kind}", kind, path=scratch(spark, "table") if kind == "table" else None
        )
        .groupBy(F.lit(kind).alias("kind"), "o_orderstatus")
        .agg(F.count("*").alias("n"))
        for kind in ("view", "table")
    ]
    return counts[0].unionByName(counts[1])


@query(
    "s14_bucketed_layout",
    """SELECT l_suppkey, count(*) AS n, max(l_extendedprice) AS top FROM lineitem
       GROUP BY l_suppkey""",
)
def s14(spark, folder):
    """Stored hashed on a key, so grouping by the key reads without a shuffle."""
    lines = table(spark, folder, "lineitem").select("l_suppkey", "l_extendedprice")
    stored = tables.publish(
        lines,
        "lines_by_supplier",
        "table",
        path=scratch(spark, "bucketed"),
        sort_by=["l_suppkey"],
        bucket_by=(tables.buckets_for(lines), "l_suppkey"),
    )
    return stored.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.max("l_extendedprice").alias("top")
    )


BATCHED = f"""SELECT {CLEAN}, ingested_at, '2026-01-01 00:00:00' AS batch_cleaned_at
  FROM (SELECT * FROM {{source}} WHERE property_id IS NOT NULL AND trim(property_id) <> ''
          AND location_raw IS NOT NULL AND price_ksh BETWEEN 3000 AND 2000000
        QUALIFY row_number() OVER (PARTITION BY property_id
          ORDER BY ingested_at DESC, scraped_at DESC, source_url DESC, location_raw DESC,
            neighbourhood DESC NULLS LAST, latitude DESC, longitude DESC,
            dist_to_archives_km DESC NULLS LAST, price_raw DESC, price_ksh DESC,
            bedrooms DESC, bathrooms DESC) = 1)"""


@query(
    "q10_batch_job",
    over(
        "raw",
        f"""SELECT * REPLACE (strftime(scraped_date, '%Y-%m-%d') AS scraped_date,
              strftime(scraped_at_eat, '%Y-%m-%d %H:%M:%S') AS scraped_at_eat) FROM (
            SELECT * FROM ({BATCHED.format(source=TARGET)}) t WHERE property_id NOT IN (
              SELECT property_id FROM ({BATCHED.format(source=STAGE)}))
            UNION ALL SELECT * FROM ({BATCHED.format(source=STAGE)}))""",
    ),
)
def q10(spark, folder):
    """Two loads into the cleaned table; the second replaces listings it has again."""
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    before, after = landing_split(spark, folder)
    shape = staging.batch_cleaned(before.select(CANONICAL_COLUMNS), stamp).schema
    raw_table = KeyedTable(spark, scratch(spark, "raw"), CANONICAL, ["property_id"])
    cleaned = KeyedTable(spark, scratch(spark, "cleaned"), shape, ["property_id"])
    for version, rows in enumerate((before, after), start=1):
        batch_job.load_batch(rows, raw_table, cleaned, version, stamp)
    return cleaned.read()
