"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.llm import decontaminate, near_duplicates, packing, pii, quality
from rentlens.llm.queries import table
from rentlens.operators.spool import spool

#: No SQL has the fitted classifier or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def accept_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    return quality.keep(docs, quality.fit(docs, table(spark, folder, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_duplicates.keep(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.keep(docs, table(spark, folder, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with marks in place of personal data."""
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents with their place in sequences of fixed length."""
    rows = packing.pieces(docs)
    return packing.pack(rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("quality", accept_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
