"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are runs of 0-9, a-z (A-Z in lower case) and characters from U+0080. A window is 10
consecutive words of a benchmark item, or a whole item of fewer words. Of each run of six
5-grams, which is one window, the least hash is kept as its fingerprint, on both sides
alike; so every shared span of 10 words shares a fingerprint. The fingerprints are joined
and a hit is extended to the window around it, word by word. Items of fewer words have
one fingerprint each: the hash of all their words.

Before the join, fingerprints are looked up in a bitmap of the benchmark's; it is a
literal of bounded size, and passes more when the benchmark outgrows it, never less.

Defined results: null text has no words. Items without words have no windows; an item
without id marks words but is not counted. Repeated items count once by their id.
Repeated rows of documents give repeated results.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.operators.spool import spool

WINDOW = 10
GRAM = 5
#: Fixed value: what separates words, after A-Z have become a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The bitmap has 16 bits for each fingerprint, within these powers of two.
LEAST_BITS, MOST_BITS = 16, 24
#: Letters that lower() would change and that are not A-Z.
_OTHER_CAPITALS = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^A-Z]]"


def words(text: Column) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is much faster; it does the same where no other capitals are.
    lowered = F.when(text.rlike(_OTHER_CAPITALS), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often and deep it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(last: Column) -> Column:
    """0 to `last`; none if it is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(found: Column, k: int) -> Column:
    return F.transform(_places(F.size(found) - k), lambda i: F.xxhash64(F.slice(found, i + 1, F.lit(k))))


def _window(found: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(found, start + 1, F.lit(length)), " ")


def _hit(fingerprint: Column, start: Column, length: int, window: Column) -> Column:
    return F.struct(
        fingerprint.alias("fingerprint"), start.cast("int").alias("start"), F.lit(length).alias("length"), window.alias("window")
    )


def _hits(found: Column, length: int, passes: Callable[[Column], Column]) -> Column:
    """Windows of `length` words around the fingerprints that pass."""
    k = min(GRAM, length) if length == WINDOW else length
    run = length - k + 1

    def around(grams: Column) -> Column:
        at = F.filter(_places(F.size(grams) - 1), lambda i: passes(F.get(grams, i)))

        def extended(i: Column) -> Column:
            first = F.greatest(i - (run - 1), F.lit(0))
            last = F.least(i, F.size(grams) - run)
            starts = F.filter(
                F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>")),
                lambda s: F.array_min(F.slice(grams, s + 1, F.lit(run))) == F.get(grams, i),
            )
            return F.transform(starts, lambda s: _hit(F.get(grams, i), s, length, _window(found, s, length)))

        return F.flatten(F.transform(at, extended))

    return let(_gram_hashes(found, k), around)


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, length, start, fingerprint and window of every window of every item."""
    items = benchmark.select(F.col("item_id"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    items = spool(items)

    def rows(part: DataFrame, length: int) -> DataFrame:
        return part.select("item_id", F.explode(_hits(F.col("w"), length, lambda _: F.lit(True))).alias("h")).select("item_id", "h.*")

    out = rows(items.filter(F.size("w") >= WINDOW), WINDOW)
    lengths = items.filter(F.size("w") < WINDOW).select(F.size("w").alias("n")).distinct().collect()
    for n in sorted(r["n"] for r in lengths):
        out = out.unionByName(rows(items.filter(F.size("w") == n), n))
    return out


def _bitmap(fingerprints: DataFrame, n: int) -> tuple[str, int]:
    """Bits by the leading bits of the fingerprints, as numbers of 64 bits."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(16 * n + 1))))
    place, bit = _place("fingerprint", bits)
    rows = fingerprints.groupBy(place.alias("place")).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("bits")).collect()
    numbers = ["0"] * (1 << (bits - 6))
    for row in rows:
        numbers[row["place"]] = str(row["bits"])
    return ",".join(numbers), bits


def _place(column: str, bits: int) -> tuple[Column, str]:
    return (
        F.expr(f"cast(shiftrightunsigned({column}, {64 - bits + 6}) as int)"),
        f"cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int)",
    )


def scan(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of `docs` (doc_id, text) with their number of words and a digest of the text;
    and for each such row with a hit, its spans and items."""
    windows = spool(_item_windows(benchmark))
    known = spool(
        windows.groupBy("fingerprint", "window").agg(F.collect_set("item_id").alias("items"))
    )
    fingerprints = known.select("fingerprint").distinct()
    numbers, bits = _bitmap(fingerprints, fingerprints.count())
    # The table is one constant of the plan; its size is bounded by MOST_BITS.
    table = F.split(F.lit(numbers), ",").cast("array<bigint>")

    def passes(gram: Column) -> Column:
        place = F.shiftrightunsigned(gram, 64 - bits + 6).cast("int")
        bit = F.shiftrightunsigned(gram, 64 - bits).bitwiseAND(F.lit(63)).cast("int")
        return F.getbit(F.get(table, place), bit) == 1

    lengths = [r["length"] for r in windows.select("length").distinct().collect()]

    def looked_up(found: Column) -> Column:
        hits = [_hits(found, n, passes) for n in sorted(lengths)]
        return F.struct(F.size(found).cast("long").alias("n_words"), (F.concat(*hits) if hits else F.array()).alias("hits"))

    columns = [F.col("doc_id"), F.col("text")]
    rows = spool(
        docs.select(*columns)
        .select(
            "doc_id", F.monotonically_increasing_id().alias("_row"),
            F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("_digest"),
            let(words(F.col("text")), looked_up).alias("_r"),
        )
        .select("doc_id", "_row", "_digest", "_r.n_words", "_r.hits")
    )
    if not lengths:
        return rows.drop("hits"), _no_spans(rows)
    hits = rows.select("_row", F.inline("hits"))
    found = (
        hits.join(known, ["fingerprint", "window"])
        .groupBy("_row")
        .agg(
            F.collect_set(F.struct("start", "length")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
    )
    return rows.drop("hits"), found


def _no_spans(rows: DataFrame) -> DataFrame:
    return rows.select(
        "_row", F.array().cast("array<struct<start:int,length:int>>").alias("spans"), F.array().cast("array<bigint>").alias("items")
    ).filter("false")


def _covered(spans: Column) -> Column:
    """Words inside any span."""

    def add(have: Column, span: Column) -> Column:
        start, end = span["start"].cast("long"), (span["start"] + span["length"]).cast("long")
        more = F.greatest(F.lit(0).cast("long"), end - F.greatest(have["reach"], start))
        return F.struct((have["total"] + more).alias("total"), F.greatest(have["reach"], end).alias("reach"))

    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(F.array_sort(spans), zero, add, lambda have: have["total"])


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, spans (start and length in words) and items of every row."""
    rows, found = scan(docs, benchmark)
    return rows.join(found, "_row", "left").select(
        "doc_id", "n_words", F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.array_sort("spans"), F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )


def keep(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of `docs` without a window of the benchmark, with their columns."""
    rows, found = scan(docs, benchmark)
    hit = spool(rows.join(found, "_row", "left_semi").select(F.col("_digest").alias("__digest")).distinct())
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    return docs.join(hit, digest == hit["__digest"], "left_anti").select(docs.columns)
