"""A corpus job in five stages, each one of the operators of quillmark.llm.

Quality and toxicity drop the documents they reject, near-dedup keeps one document of
each group, secret scans mask what they find, and packing lays the token sequences of
what is left out. Every stage but the last returns the columns of its input.

The stages bound the Arrow batches of their session (``BATCH_ROWS``).

Null texts count as empty, rows without an id are never linked with others, and an empty
input passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillmark.llm import minhash, packing, quality, secret_scan, toxicity
from quillmark.llm.common import read, stage

#: Rows of whole texts that travel to a Python worker at once; 10,000, the default, can take
#: hundreds of megabytes in each worker and its executor.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends texts to Python workers in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field rates at least 0.7."""
    small_batches(spark)
    return quality.kept(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def harmless_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.7."""
    small_batches(spark)
    return toxicity.kept(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    small_batches(spark)
    return minhash.deduplicated(docs)


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with every secret replaced by a mask."""
    return secret_scan.redact(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    small_batches(spark)
    return packing.pack_documents(docs)


Stage = tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]

STAGES: list[Stage] = [
    ("quality", good_documents),
    ("toxicity", harmless_documents),
    ("near_duplicates", distinct_documents),
    ("secrets", masked_documents),
    ("packing", packed_sequences),
]
#: Trained classifiers and packing are not SQL; tests compare with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all rows that the one before kept, written and read in between."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
