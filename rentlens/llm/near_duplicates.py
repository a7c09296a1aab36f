"""Near duplicates by MinHash: fast similarity sketching, banding, exact verification.

A document's set is its different 5-word shingles (all words as one, if it has fewer).
Documents are linked when 100 * intersection >= 75 * union; groups are what links
connect, and the document of smallest id stays.

Sketch: in round r every shingle is thrown into one of T bins with a hashed value; a bin
keeps the smallest (round, value). After T rounds, round T + b throws all shingles into
bin b, so that no bin stays empty. Two sketches agree in a bin with probability equal to
the similarity of the sets, concentrated as with independent hashes, and a set of many
more than T shingles is looked at once.

Copies (equal sets) are one class; classes, not documents, are compared. In each band of
bins, equal values make a bucket. In the first bands, a bucket links its members to a
centre, another one in each band. Buckets, of any band, whose members are not all
connected by verified links are searched through for pairs across groups, in blocks of bounded size, with the sketches: pairs
whose sketches could stand for the similarity are compared too. All links are confirmed
on the full sets (as 64-bit hashes of the shingles).

Defined results: null text, or text without words, has an empty set and links with
nothing. A row without id takes no part: its component is null and it is kept. Rows of one
id are one document: where their sets differ, the set of smallest key that is not empty
stands for it, and all its rows get the size and component of that set. Ties do not arise,
since the smallest id stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm import arrays, bitmaps
from rentlens.llm.components import components
from rentlens.operators.spool import spool

SHINGLE = 5
PERCENT = 75
BINS = 128
BAND = 4
#: Sketches that agree in fewer bins are not of similar sets: five deviations below.
LEAST_AGREEING = int(BINS * PERCENT / 100 - 5 * (BINS * 0.75 * 0.25) ** 0.5)
#: Bands whose buckets link their members to a centre before the search.
CENTRED = 6
#: Members of a bucket, and shingles they have, in one block of the search, about.
BLOCK_ROWS = 512
BLOCK_ITEMS = 500_000
BLOCK = "bucket long, band int, rep long, n long, root long, i int, j int, own int"
SKETCHED = "doc_id long, n_shingles long, key_a long, key_b long, bands array<long>"


def sets(column: pa.Array) -> list[np.ndarray]:
    """The different shingle hashes of each text, ascending."""
    data, bounds = arrays.utf8(column)
    starts, ends, first = arrays.words(data, bounds)
    hashes, begin = arrays.shingles(arrays.word_hashes(data, starts, ends), first, SHINGLE)
    return [np.unique(hashes[begin[i] : begin[i + 1]]) for i in range(len(column))]


@cache
def _seeds() -> np.ndarray:
    return np.random.default_rng(77).integers(1, 1 << 63, 2 * BINS, dtype=np.uint64)


def sketch(items: np.ndarray) -> np.ndarray:
    """BINS values of 32 bits for a set that is not empty."""
    seeds = _seeds()
    out = np.zeros(BINS, dtype=np.uint32)
    open_bins = np.ones(BINS, dtype=bool)
    at_once = max(1, 1024 // len(items))
    for begin in range(0, BINS, at_once):
        rounds = np.arange(begin, min(BINS, begin + at_once), dtype=np.uint64)
        x = arrays.mix(items[None, :] ^ seeds[rounds.astype(np.int64)][:, None])
        # Ordered by bin, then by round, then by value.
        key = (x & np.uint64(BINS - 1)) << np.uint64(48) | (rounds - np.uint64(begin))[:, None] << np.uint64(32) | x >> np.uint64(32)
        key = np.sort(key, axis=None)
        bins = (key >> np.uint64(48)).astype(np.int64)
        lead = np.ones(len(bins), dtype=bool)
        lead[1:] = bins[1:] != bins[:-1]
        bins, values = bins[lead], (key[lead] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        fresh = open_bins[bins]
        out[bins[fresh]] = values[fresh]
        open_bins[bins] = False
        if not open_bins.any():
            return out
    rest = np.flatnonzero(open_bins)
    out[rest] = (arrays.mix(items[None, :] ^ seeds[BINS + rest][:, None]) >> np.uint64(32)).min(axis=1)
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """One key for each band, different between bands."""
    grouped = values.reshape(-1, BAND).astype(np.uint64)
    key = np.arange(len(grouped), dtype=np.uint64) + np.uint64(1)
    for j in range(BAND):
        key = arrays.mix(key * np.uint64(0x9E3779B97F4A7C15) + grouped[:, j])
    return key.view(np.int64)


def _keys(items: np.ndarray) -> np.ndarray:
    """128 bits that stand for a set."""
    return np.frombuffer(hashlib.blake2b(items.tobytes(), digest_size=16).digest(), np.int64)


def sketched(docs: DataFrame) -> DataFrame:
    """Size, 128-bit key and band keys of the set of every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.parts(batch):
                found = sets(part.column("text"))
                keys = np.array([_keys(s) for s in found])
                made = [bands(sketch(s)) if len(s) else None for s in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([len(s) for s in found], pa.int64()),
                        pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(made, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "key_a", "key_b", "bands"],
                )

    return _texts(docs).mapInArrow(run, SKETCHED)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of `docs` (doc_id, text)."""
    return _grouped(docs, percent).drop("key_a")


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """The columns of `groups`, and a key of the set that stands for the id."""
    rows = spool(sketched(docs))
    repeated = spool(_repeated(rows))
    rows = _one_set(rows, repeated)
    sized = rows.filter("doc_id IS NOT NULL AND n_shingles > 0 AND own")
    # A class is a set; its document of smallest id stands for it.
    classes = spool(
        sized.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"))
    )
    chosen = sized.join(classes, (sized["doc_id"] == classes["rep"]) & (sized["key_a"] == classes["key_a"]) & (sized["key_b"] == classes["key_b"]))
    chosen = _once(chosen.select("rep", "n", sized["key_a"], "bands"), repeated, "rep")
    roots = _class_roots(docs, repeated, chosen, percent)
    placed = classes.join(roots, classes["rep"] == roots["node"], "left").select(
        "key_a", "key_b", F.coalesce("root", "rep").alias("_root")
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id"))
    return rows.join(placed, ["key_a", "key_b"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, own).otherwise(F.col("doc_id")).alias("component_id"), "key_a"
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _repeated(rows: DataFrame) -> DataFrame:
    """Ids on more than one row, with the size and keys of the set that stands for each."""
    stands = F.min(F.struct((F.col("n_shingles") == 0).alias("empty"), "key_a", "key_b", "n_shingles"))
    ids = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("_rows"), stands.alias("_set"))
    return ids.filter("_rows > 1").select("doc_id", *[F.col(f"_set.{c}").alias(f"_{c}") for c in ("key_a", "key_b", "n_shingles")])


def _one_set(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """`rows` with the keys and size that stand for their id, and own: whether the bands
    are those of that set."""
    same = (F.col("key_a") == F.col("_key_a")) & (F.col("key_b") == F.col("_key_b"))
    return rows.join(repeated, "doc_id", "left").select(
        "doc_id", *[F.coalesce(f"_{c}", c).alias(c) for c in ("n_shingles", "key_a", "key_b")],
        "bands", F.coalesce(same, F.lit(True)).alias("own"),
    )


def _once(rows: DataFrame, repeated: DataFrame, column: str) -> DataFrame:
    """`rows` with one row for each of the repeated ids in `column`; only these are moved."""
    ids = repeated.select(F.col("doc_id").alias(column))
    return rows.join(ids, column, "left_anti").unionByName(rows.join(ids, column, "left_semi").dropDuplicates([column]))


def _class_roots(docs: DataFrame, repeated: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """node and root of every class that is linked with another."""
    members = spool(_shared_buckets(chosen))
    wanted = spool(members.select(F.col("rep").alias("doc_id"), "key_a").distinct())
    held = spool(_once(_full_sets(docs, wanted), repeated, "doc_id"))
    links = spool(verified(_with_centres(members, percent), held, percent))
    roots = spool(components(links))
    more = spool(_searched(members, held, roots, percent))
    return roots if more.isEmpty() else components(links.unionByName(more))


def _shared_buckets(chosen: DataFrame) -> DataFrame:
    """band, bucket, rep and n, of the buckets with more than one member, and their centre."""
    rows = chosen.select("rep", "n", "key_a", F.posexplode("bands").alias("band", "bucket"))
    centres = (
        rows.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("bucket", "rep").alias("_h"), "rep", "n")).alias("_c"))
        .filter("size > 1")
        .select("bucket", "size", F.col("_c.rep").alias("centre"), F.col("_c.n").alias("centre_n"))
    )
    return rows.join(centres, "bucket")


def _near_size(x: str, y: str, percent: int) -> Column:
    """Sets of these sizes can be similar at all."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _with_centres(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a member and the centre of its bucket, in the first bands."""
    pairs = members.filter((F.col("band") < CENTRED) & (F.col("rep") != F.col("centre")) & _near_size("n", "centre_n", percent))
    return pairs.select(F.greatest("rep", "centre").alias("a"), F.least("rep", "centre").alias("b")).distinct()


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and shingles of the documents that are compared: of the rows of an id, those
    whose set has the wanted key. Other texts are not shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.parts(batch):
                found = sets(part.column("text"))
                same = np.array([_keys(s)[0] for s in found], dtype=np.int64) == part.column("key_a").to_numpy()
                items = [s.view(np.int64) for s, take in zip(found, same, strict=True) if take]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").filter(pa.array(same)), pa.array(items, pa.list_(pa.int64()))], ["doc_id", "items"]
                )

    rows = _texts(docs).filter(bitmaps.may_hold(wanted))
    return rows.join(wanted, "doc_id").mapInArrow(run, "doc_id long, items array<long>")


def verified(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar."""
    left = held.select(F.col("doc_id").alias("a"), F.col("items").alias("_x"))
    right = held.select(F.col("doc_id").alias("b"), F.col("items").alias("_y"))
    common = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - common
    return pairs.join(left, "a").join(right, "b").filter(common * 100 >= union * percent).select("a", "b")


def _searched(members: DataFrame, held: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) between members of one bucket that are not connected yet.

    Buckets are dealt into blocks of bounded size, and each two blocks of a bucket meet in
    one task. Sizes and sketches rule out most pairs, before a set is sent to a block; the
    full sets decide on the others, and of the links found there, those that connect what
    was not connected are returned.
    """
    rows = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_ITEMS)).cast("int")
    open_buckets = (
        rows.groupBy("bucket").agg(F.min("root").alias("_x"), F.max("root").alias("_y"), blocks.alias("blocks"))
        .filter("_x <> _y").select("bucket", "blocks")
    )
    rows = rows.select("bucket", "band", "rep", "n", "root").join(open_buckets, "bucket")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    grid = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), own.alias("own")),
    )
    spread = rows.select("bucket", "band", "rep", "n", "root", F.explode(grid).alias("g")).select(
        "bucket", "band", "rep", "n", "root", "g.i", "g.j", "g.own"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sketch(x).tobytes() if len(x) else None for x in _lists(batch.column("items"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], ["rep", "sketch"])

    wanted = rows.select(F.col("rep").alias("doc_id")).distinct()
    sketches = spool(held.join(wanted, "doc_id", "left_semi").mapInArrow(run, "rep long, sketch binary"))

    def fit(table: pa.Table) -> pa.Table:
        block = _Block(table, percent)
        lone = np.ones(len(block.rep), dtype=bool)
        for x in range(1, len(lone)):
            at = block.candidates(x)[0]
            lone[at] = False
            lone[x] &= not len(at)
        kept = ["bucket", "band", "rep", "n", "root", "i", "j", "own", "sketch"]
        return table.select(kept).filter(pa.array(~lone))

    # Sketches meet first: the sets, which are much larger, only of those that have a partner.
    fitting = spool(spread.join(sketches, "rep").groupBy("bucket", "i", "j").applyInArrow(fit, f"{BLOCK}, sketch binary"))

    def compare(table: pa.Table) -> pa.Table:
        links = np.array(_links_between(table, percent), dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    items = held.select(F.col("doc_id").alias("rep"), "items")
    return fitting.join(items, "rep").groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _lists(column: pa.Array) -> list[np.ndarray]:
    """Lists of numbers, each ascending as unsigned numbers."""
    return [x.values.to_numpy().view(np.uint64) if x.is_valid else np.zeros(0, dtype=np.uint64) for x in column]


class _Block:
    """Members of one bucket, and which of them their sizes and sketches rule out."""

    def __init__(self, table: pa.Table, percent: int):
        self.rep, self.n, self.root, self.own = (table.column(c).to_numpy() for c in ("rep", "n", "root", "own"))
        self.values = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint32).reshape(-1, BINS)
        self.within = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        self.band = table.column("band")[0].as_py()
        self.percent = percent

    def candidates(self, x: int) -> tuple[np.ndarray, np.ndarray]:
        """Members before x that can be similar to it, and in how many bins they agree."""
        n, root = self.n, self.root
        fit = root[:x] != root[x]
        fit &= np.minimum(n[:x], n[x]) * 100 >= np.maximum(n[:x], n[x]) * self.percent
        if not self.within:
            fit &= self.own[:x] != self.own[x]
        at = np.flatnonzero(fit)
        same = self.values[at] == self.values[x]
        agreeing = same.sum(axis=1)
        # A pair is looked at in the first band that it shares.
        first = same.reshape(len(at), BINS // BAND, BAND).all(axis=2).argmax(axis=1)
        take = (agreeing >= LEAST_AGREEING) & (first == self.band)
        return at[take], agreeing[take]


def _links_between(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    block = _Block(table, percent)
    rep, root = block.rep, block.root
    items = _lists(table.column("items").combine_chunks())
    joined = {r: r for r in root.tolist()}

    def find(r: int) -> int:
        while joined[r] != r:
            joined[r] = joined[joined[r]]
            r = joined[r]
        return r

    links = []
    for x in range(1, len(rep)):
        at, agreeing = block.candidates(x)
        for y in at[np.argsort(-agreeing, kind="stable")].tolist():
            r, t = find(int(root[x])), find(int(root[y]))
            if r == t:
                continue
            common = len(np.intersect1d(items[x], items[y], assume_unique=True))
            if common * 100 >= (len(items[x]) + len(items[y]) - common) * percent:
                links.append((max(int(rep[x]), int(rep[y])), min(int(rep[x]), int(rep[y]))))
                joined[max(r, t)] = min(r, t)
    return links


def keep(docs: DataFrame) -> DataFrame:
    """`docs` without the near duplicates of a document that stays; of repeated rows of
    one id, one with the set that stands for it stays."""
    found = spool(_grouped(docs, PERCENT).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("_rows"), F.min("key_a").alias("key_a"), F.first("kept").alias("kept")
    ))
    # All rows of an id are kept or none, so most texts need no join.
    judged = spool(found.filter("NOT kept OR _rows > 1"))
    looked_up = bitmaps.may_hold(judged)
    columns = docs.columns
    kept = docs.filter(~looked_up).unionByName(
        docs.filter(looked_up).join(judged.select("doc_id"), "doc_id", "left_anti").select(columns)
    )
    repeated = judged.filter("kept").select("doc_id", F.col("key_a").alias("__key_a"))
    if not repeated.isEmpty():
        held = docs.filter(bitmaps.may_hold(repeated)).join(repeated, "doc_id")
        kept = kept.unionByName(_standing(held.select(*columns, "__key_a"), docs).dropDuplicates(["doc_id"]))
    return kept


def _standing(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Of `rows` with a wanted __key_a, those whose set has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrays.parts(batch):
                own = np.array([_keys(s)[0] for s in sets(part.column("text"))], dtype=np.int64)
                yield part.filter(pa.array(own == part.column("__key_a").to_numpy())).drop_columns(["__key_a"])

    return rows.mapInArrow(run, docs.schema)
