"""The corpus pipeline: quality rules, near-duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of documents, extra
columns included, whatever their names.

Nulls, repeats and empty tables: a null text has no words, so the first stage rejects it; texts that a
stage leaves empty are kept with an empty text. Rows with a null id are rows like others; of a group of
near copies the row with the smallest id stays, null ids last. Repeated rows are one group of copies,
so one of them passes the second stage. An empty table passes every stage as an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import minhash, packing, quality, queries, secrets, suffix_dedup
from ledgerloom.llm.common import ship, table
from ledgerloom.operators.materialize import materialize

Docs = DataFrame

# A pair at similarity 0.8 is missed with probability 2 * (1 - 0.8**3)**14 = 9e-5.
NEAR = minhash.Settings(words=5, percent=80, tables=14)


def quality_rules(spark: SparkSession, docs: Docs, sf_dir: str) -> Docs:
    """Documents that pass every quality rule; null and empty texts have too few words."""
    return quality.keep_documents(docs, quality.DEFAULT)


def near_dedup(spark: SparkSession, docs: Docs, sf_dir: str) -> Docs:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8.

    Of repeated rows one stays; documents without words stay once per id and text.
    """
    ship(spark)
    return minhash.keep_one(docs, NEAR)


def repeated_passages(spark: SparkSession, docs: Docs, sf_dir: str) -> Docs:
    """All documents, without what an earlier document or place has; null texts become empty."""
    ship(spark)
    return suffix_dedup.deduplicate(docs)


def secret_scans(spark: SparkSession, docs: Docs, sf_dir: str) -> Docs:
    """All documents, found secrets masked; a null text stays null."""
    ledger = secrets.Ledger(spark, queries.scratch(spark, "pipeline_ledger"))
    return secrets.redact(docs, ledger)


def pack(spark: SparkSession, docs: Docs, sf_dir: str) -> DataFrame:
    """Pieces of documents placed in training sequences, with their token ids.

    An empty or null text is one piece, the closing id.
    """
    ship(spark)
    return packing.pack(docs, queries.vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("repeated_passages", repeated_passages),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

# The last stage tokenises, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table; what a stage returns is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}-{uuid.uuid4().hex[:8]}")
    return STAGES[-1][1](spark, docs, sf_dir)
