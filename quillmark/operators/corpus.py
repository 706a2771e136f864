"""Corpora: labels, domain checks and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def attach_labels(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "label"
) -> DataFrame:
    """Documents that have a label. The planner picks the join by measured size."""
    return documents.join(labels.select(key, label), key, "inner")


def conversation_corpus(conversations: DataFrame) -> DataFrame:
    """Assistant turns are class 1, user turns class 0, other roles are left out."""
    return conversations.filter(F.col("role").isin("assistant", "user")).select(
        F.concat_ws("-", "conv_id", "turn").alias("doc_id"),
        "text",
        (F.col("role") == "assistant").cast("int").alias("label"),
    )


def label_stratum(label: Column) -> Column:
    """The label itself, or an error: proves there are two strata at most."""
    return F.when(label.isin(0, 1), label.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("label is not 0 or 1: "), F.coalesce(label.cast("string"), F.lit("null"))))
    )


def label_domain(df: DataFrame, label: str = "label") -> DataFrame:
    """Each distinct label with its row count and whether it is allowed."""
    return (
        df.groupBy(F.col(label).alias("label"))
        .agg(F.count("*").alias("n"))
        .withColumn("valid", F.coalesce(F.col("label").isin(0, 1), F.lit(False)))
    )


def check_labels(df: DataFrame, label: str = "label") -> None:
    """Raise unless every label is 0 or 1. A string label never passes."""
    if dict(df.dtypes)[label] == "string":
        raise ValueError(f"label column {label!r} holds strings, expected 0 and 1")
    bad = (
        label_domain(df.withColumn(label, F.col(label).cast("double")), label)
        .filter(~F.col("valid"))
        .orderBy("label")
        .limit(20)
        .collect()
    )
    if bad:
        raise ValueError(f"labels must be 0 or 1, found: {[r['label'] for r in bad]}")


def check_unique(df: DataFrame, key: str) -> None:
    """Raise unless every row has a key of its own. Only keys are shuffled."""
    twice = df.groupBy(key).agg(F.count("*").alias("n")).filter(f"n > 1 OR {key} IS NULL")
    bad = twice.orderBy(key).limit(20).collect()
    if bad:
        raise ValueError(f"column {key!r} must be unique and not null, found: {[r[key] for r in bad]}")


def corpus_counts(sentences: DataFrame, split: str = "split") -> DataFrame:
    """Texts and sentences per split, and over everything (split ``all``).

    A text is counted once per split it occurs in, and once in the total.
    """
    per_text = sentences.groupBy(F.col(split).alias("split"), "doc_id").agg(
        F.count("*").alias("n")
    )
    per_split = per_text.groupBy("split").agg(
        F.count("*").alias("texts"), F.sum("n").alias("sentences")
    )
    total = (
        per_text.groupBy("doc_id")
        .agg(F.sum("n").alias("n"))
        .agg(F.count("*").alias("texts"), F.coalesce(F.sum("n"), F.lit(0)).alias("sentences"))
        .select(F.lit("all").alias("split"), "texts", "sentences")
    )
    return per_split.unionByName(total)


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share per class; the window only sees one row per class."""
    return (
        df.groupBy(F.col(label).alias("label"))
        .agg(F.count("*").alias("n"))
        .withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(F.lit(0))))
    )
