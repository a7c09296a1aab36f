"""The operators over whole tables, each as one query, and what SQL can check of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.llm import (
    attribution,
    conversations,
    decontaminate,
    language,
    near_duplicates,
    nearest,
    packing,
    passages,
    pii,
    quality,
    training_order,
    warc,
    whitening,
)
from rentlens.registry.base import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checksum(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.filter(F.coalesce(checksum() % 4, F.lit(0)) != 2))
    found = language.identify(docs, model)
    return found.withColumn("held_out", F.coalesce(checksum() % 4 == 2, F.lit(False)))


@query
def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = F.filter("found", lambda s: s["kind"].isin(pii.KINDS[: pii.BASE_KINDS]))
    return found.select(
        "doc_id", *[count(kind) for kind in pii.KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
    )


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels.filter(checksum() % 5 != 0))
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(checksum() % 5 == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    rows = packing.pieces(table(spark, folder, "documents"))
    return packing.pack(rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.attribute(table(spark, folder, "documents"))


@query
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.groups(table(spark, folder, "documents"))


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op2_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS passage
    FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (
    SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS passage
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, passage)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op5_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op6_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated(table(spark, folder, "documents"))


@query
def op9_training_order(spark: SparkSession, folder: str) -> DataFrame:
    return training_order.materialise(table(spark, folder, "documents"))


ORACLES["op4_near_duplicates"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w FROM documents),
items AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + k - 1], ' ') AS item
    FROM (SELECT doc_id, w, least(len(w), 5) AS k, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM items GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM items x JOIN items y USING (item) WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM d
    UNION SELECT reach.doc_id, edge.b FROM reach JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) edge ON edge.a = reach.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@query
def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


ORACLES["op13_warc"] = f"""
SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN n > 1 THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n > 1 THEN kept END AS refers_to
FROM (SELECT page_id, payload,
        CASE WHEN octet_length(payload) >= {warc.LEAST_SHARED}
             THEN row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) ELSE 1 END AS n,
        max(page_id) OVER (PARTITION BY payload) AS kept
      FROM (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages))
"""


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversations.damaged(table(spark, folder, "conversations"))
    return conversations.Repair(rows, keep_texts=False).report


def _least_edits() -> str:
    """The step over one row, as SQL: four least edits so far, each as ten digits of cost and
    the initials, so that the least text is the least edits; null where there are none."""
    states, ahead = range(4), {0: 2, 1: 2, 2: 3, 3: 2}

    def grown(text: str, cost: str, letters: str) -> str:
        return f"(lpad(CAST(CAST(left({text}, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({text}, 11) || '{letters}')"

    options: dict[int, list[str]] = {q: [] for q in states}
    for p in states:
        text, at = f"s{p}", p
        for _ in range(3):
            free, u, a = "NOT forced", at in (0, 1, 3), at == 2
            options[at].append(grown(text, "2", "D"))
            if at == 0:
                options[1].append(f"CASE WHEN {free} AND initial = 's' THEN {grown(text, 'extra', 'K')} END")
            if u or a:
                to, own = (2, "u") if u else (3, "a")
                options[to].append(f"CASE WHEN {free} AND initial = '{own}' THEN {grown(text, 'extra', 'K')} END")
                options[to].append(f"CASE WHEN {free} THEN {grown(text, '1 + extra', 'R')} END")
            text, at = grown(text, "5", "I"), ahead[at]
    return ", ".join(f"least({', '.join(options[q])}) AS s{q}" for q in states)


ORACLES["op11_conversation_repair"] = rf"""
WITH RECURSIVE plain AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
-- The checksum, a byte at a time.
bits(place, i, c) AS (
    SELECT DISTINCT place, 0, 4294967295::BIGINT FROM plain
    UNION ALL
    SELECT place, i + 1, list_reduce(list_prepend(xor(c, CAST(ascii(place[i + 1]) AS BIGINT)), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)
    FROM bits WHERE i < len(place)),
coded AS (
    SELECT p.*, xor(c, 4294967295::BIGINT) % 20 AS code FROM plain p JOIN bits b ON b.place = p.place AND b.i = len(b.place)),
damaged AS (
    SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM coded WHERE code <> 0),
judged AS (
    SELECT *, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
           row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
           lag(left(role, 1)) OVER w AS before
    FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(len(role) || ':' || role || text), copy)),
faults AS (
    SELECT *, bare = '' AS blank, bare <> '' AND seen > 1 AS duplicate,
           bare <> '' AND seen = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated FROM judged),
steps AS (SELECT *, blank OR duplicate AS forced, CASE WHEN truncated THEN 5 ELSE 0 END AS extra FROM faults),
ways(conv_id, i, s0, s1, s2, s3) AS (
    SELECT DISTINCT conv_id, 0::BIGINT, '0000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM conversations
    UNION ALL
    SELECT conv_id, i, s0, s1, s2, s3 FROM (
        SELECT w.conv_id, w.i + 1 AS i, {_least_edits()}
        FROM ways w JOIN steps t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1)),
ended AS (
    SELECT conv_id, least(s0, s3, lpad(CAST(CAST(left(s2, 10) AS BIGINT) + 5 AS VARCHAR), 10, '0') || substr(s2, 11) || 'I',
                          lpad(CAST(CAST(left(s1, 10) AS BIGINT) + 10 AS VARCHAR), 10, '0') || substr(s1, 11) || 'II') AS best
    FROM ways QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
edits AS (
    SELECT conv_id, letter, k, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) AS i
    FROM (SELECT conv_id, unnest(string_split(substr(best, 11), '')) AS letter, generate_subscripts(string_split(substr(best, 11), ''), 1) AS k
          FROM ended WHERE len(best) > 10)),
put AS (
    SELECT e.conv_id, k, letter, role, text, row_number() OVER (PARTITION BY e.conv_id ORDER BY k) AS o,
           count(*) OVER (PARTITION BY e.conv_id) % 2 AS odd
    FROM edits e LEFT JOIN steps t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.i = e.i WHERE letter <> 'D'),
repaired AS (
    SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
               || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS lines FROM put GROUP BY conv_id),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
           count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
           count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(left(best, 10) AS BIGINT) AS cost,
       substr(best, 11) AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""
