"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.sources.staging import stage

#: Words are runs of anything but these six ASCII white-space characters.
SPACES = "[\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null text as the empty text; other columns are left out."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal id, modulo n; ids that are null fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def sampled_labels(
    docs: DataFrame, labels: DataFrame, target: str, n_folds: int, held: int, per_class: int
) -> list[tuple[int, int]]:
    """At most ``per_class`` (doc_id, label) rows of each class outside the held-out fold.

    The choice follows a hash of the id, so it does not depend on partitions. Only
    documents that are present count; a document with several labels takes the largest.
    """
    rows = (
        labels.select("doc_id", F.col(target).alias("y"))
        .where("doc_id IS NOT NULL AND y IN (0, 1)")
        .where(fold(F.col("doc_id"), n_folds) != held)
        .join(docs.select("doc_id"), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    found: list[tuple[int, int]] = []
    for y in (0, 1):
        best = (
            rows.where(F.col("y") == y)
            .orderBy(F.xxhash64(F.col("doc_id"), F.lit(17)), "doc_id")
            .limit(per_class)
        )
        found += [(r.doc_id, y) for r in best.collect()]
    return found


def with_labels(docs: DataFrame, chosen: list[tuple[int, int]]) -> DataFrame:
    """The texts of the chosen documents with their labels; the id list is bounded by the sample.

    Rows that repeat a document count once.
    """
    spark = docs.sparkSession
    ids = spark.createDataFrame(chosen or [], "doc_id bigint, y int")
    return texts(docs).join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])


def logistic_fit(x, y, l2: float = 1e-3, steps: int = 40):
    """Weights of a logistic regression with intercept (last), by damped Newton steps.

    One class alone gives its rate as a constant score.
    """
    import numpy as np

    x = np.column_stack([np.asarray(x, float), np.ones(len(y))]) if len(y) else np.ones((0, 1))
    y = np.asarray(y, float)
    w = np.zeros(x.shape[1])
    if len(y) == 0:
        return w
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(rate / (1 - rate))
    if y.min() == y.max():
        return w
    penalty = np.full(len(w), l2 * len(y))
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def small_batches(batches: Iterator, rows: int = 256) -> Iterator:
    """Cut Arrow batches into pieces of a bounded number of rows."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def crc_fold(doc_id: int, n: int) -> int:
    """The fold of one id in plain Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % n


__all__ = ["SPACES", "crc_fold", "fold", "logistic_fit", "read", "sampled_labels", "sigmoid", "small_batches", "stage", "texts", "with_labels"]
