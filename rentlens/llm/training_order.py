"""Training order: token sequences in fixed-stride shards, by a keyed permutation.

Documents are encoded and joined, each with a closing id, and cut into sequences of fixed
length; the last one of an input partition is filled up with the closing id. Sequence i of
n goes to slot P(i), where P is a keyed Feistel network on the least even number of bits
that holds n, walked along its cycle until it falls below n. So every slot is computed,
none is drawn or stored, and the order can be had again from the key. A shard holds a range
of slots in order; each record has the same number of bytes, so slot s begins at byte
(s - first slot) * stride, and reading goes on from any slot.

A record: sequence number, id of the document its first token is of (-1 for null), number
of tokens, crc32 of the ids, the ids (unsigned 16-bit, or 32-bit for larger vocabularies),
all little-endian, and a line break, which the file format adds. Spark's committer writes
the files, so lost tasks leave no half shards, in any store that Spark writes to.

The input is encoded twice: to count the sequences of its partitions, and to write them
with their slots in one shuffle. It must be a written table, so that both readings meet
the same partitions; this is checked, and a difference ends the job.

Defined results: null text is empty, and is its closing id alone. Repeated rows are
written each for itself. An empty table gives no shards.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.llm import tokens
from rentlens.llm.arrays import mix
from rentlens.session import shared_folder

LENGTH = 2048
CLOSING_ID = 1
SHARD = 2048
KEY = 20240607
ROUNDS = 6
HEADER = np.dtype([("sequence", "<i8"), ("doc_id", "<i8"), ("n_tokens", "<u4"), ("crc32", "<u4")])


def permuted(index: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slot of each sequence number below n."""
    return _walked(index, n, _keys(key))


def sequence_at(slot: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The sequence number in each slot below n."""
    return _walked(slot, n, _keys(key), back=True)


def _keys(key: int) -> np.ndarray:
    return mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ mix(np.array([key], dtype=np.uint64)))


def _walked(values: np.ndarray, n: int, keys: np.ndarray, back: bool = False) -> np.ndarray:
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    out = np.asarray(values, dtype=np.uint64).copy()
    open_at = np.arange(len(out))
    while len(open_at):
        out[open_at] = _feistel(out[open_at], np.uint64(half), keys, back)
        open_at = open_at[out[open_at] >= n]
    return out.astype(np.int64)


def _feistel(x: np.ndarray, half: np.uint64, keys: np.ndarray, back: bool) -> np.ndarray:
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = x >> half, x & mask
    for key in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (mix(left ^ key) & mask), left
        else:
            left, right = right, left ^ (mix(right ^ key) & mask)
    return left << half | right


def id_type(vocabulary: tokens.Encoder) -> np.dtype:
    return np.dtype("<u2" if len(vocabulary.lengths) <= 1 << 16 else "<u4")


def _sequences(batches: Iterator[pa.RecordBatch], path: str, length: int, closing_id: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of full sequences (a row each), with the document of their first token and
    their numbers of tokens; the last block may hold one that is filled up."""
    encoder = tokens.encoder(path)
    rest, rest_docs = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    for batch in batches:
        ids = np.array([-1 if d is None else d for d in batch.column("doc_id").to_pylist()], dtype=np.int64)
        row = 0
        for texts in tokens.batches(batch.column("text")):
            flat, at = encoder.encode(texts)
            sizes = np.diff(at)
            flat = np.insert(flat, at[1:], np.uint32(closing_id))
            rest = np.concatenate([rest, flat])
            rest_docs = np.concatenate([rest_docs, np.repeat(ids[row : row + len(texts)], sizes + 1)])
            row += len(texts)
            full = len(rest) // length * length
            if full:
                yield rest[:full].reshape(-1, length), rest_docs[:full:length], np.full(full // length, length)
                rest, rest_docs = rest[full:], rest_docs[full:]
    if len(rest):
        filled = np.concatenate([rest, np.full(length - len(rest), closing_id, dtype=np.uint32)])
        yield filled.reshape(1, length), rest_docs[:1], np.array([len(rest)])


def _chosen(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def write(
    docs: DataFrame, folder: str, key: int = KEY, length: int = LENGTH, shard: int = SHARD,
    closing_id: int = CLOSING_ID, vocabulary: str | None = None,
) -> int:
    """Write the shards of `docs` (doc_id, text) as folder/shard=k, and return how many
    sequences they hold."""
    path = vocabulary or tokens.vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(len(ids) for ids, _, _ in _sequences(batches, path, length, closing_id))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], ["part", "n"])

    # One row for each input partition.
    counts = {r["part"]: r["n"] for r in _chosen(docs).mapInArrow(count, "part int, n long").collect()}
    begins, total = {}, 0
    for part in sorted(counts):
        begins[part] = total
        total += counts[part]
    if not total:
        return 0

    def record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        begin, done = begins.get(part, 0), 0
        kind = id_type(tokens.encoder(path))
        for ids, first, sizes in _sequences(batches, path, length, closing_id):
            numbers = np.arange(begin + done, begin + done + len(ids))
            done += len(ids)
            slots = permuted(numbers, total, key)
            records = []
            for i, row in enumerate(ids.astype(kind)):
                head = np.array([(numbers[i], first[i], sizes[i], zlib.crc32(row.tobytes()))], dtype=HEADER)
                records.append(head.tobytes() + row.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array((slots // shard).astype(np.int32)), pa.array(slots), pa.array(records, pa.binary())], ["shard", "slot", "record"]
            )
        if done != counts.get(part, 0):
            raise RuntimeError(f"partition {part} held {counts.get(part, 0)} sequences when counted, and now {done}")

    placed = _chosen(docs).mapInArrow(record, "shard int, slot long, record binary")
    (
        placed.repartitionById((total + shard - 1) // shard, "shard")
        .sortWithinPartitions("shard", "slot")
        .select("shard", F.col("record").cast("string").alias("record"))
        .write.partitionBy("shard").text(folder)
    )
    return total


def read(spark: SparkSession, folder: str, length: int = LENGTH, shard: int = SHARD, vocabulary: str | None = None) -> DataFrame:
    """slot, shard, byte_offset, sequence, doc_id, n_tokens, ids_crc32 and sound (the ids
    have their checksum) of every record in the shards."""
    path = vocabulary or tokens.vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = length * id_type(tokens.encoder(path)).itemsize
        kind = np.dtype([("head", HEADER), ("ids", "V", width), ("end", "u1")])
        for batch in batches:
            for number, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                rows = np.frombuffer(content.as_buffer(), kind)
                sums = np.array([zlib.crc32(x) for x in rows["ids"]], dtype=np.int64)
                at = np.arange(len(rows), dtype=np.int64)
                head = rows["head"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(at + number * shard), pa.array(np.full(len(rows), number, dtype=np.int32)), pa.array(at * kind.itemsize),
                        pa.array(head["sequence"].astype(np.int64)), pa.array(head["doc_id"].astype(np.int64)),
                        pa.array(head["n_tokens"].astype(np.int64)), pa.array(sums), pa.array((sums == head["crc32"]) & (rows["end"] == 10)),
                    ],
                    ["slot", "shard", "byte_offset", "sequence", "doc_id", "n_tokens", "ids_crc32", "sound"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    shape = "slot long, shard int, byte_offset long, sequence long, doc_id long, n_tokens long, ids_crc32 long, sound boolean"
    return files.select(F.col("shard").cast("int").alias("shard"), "content").mapInArrow(run, shape)


def materialise(docs: DataFrame, key: int = KEY) -> DataFrame:
    """Write the shards of `docs` into the shared folder and list their records."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/shards/{uuid.uuid4().hex}"
    if write(docs, folder, key):
        return read(spark, folder)
    return spark.createDataFrame([], "slot long, shard int, byte_offset long, sequence long, doc_id long, n_tokens long, ids_crc32 long, sound boolean")
