"""Exact, reproducible splits and samples.

Every row gets a seeded hash of its key. Taking the first q rows of a class in
hash order needs no global sort: a histogram of hash buckets finds the bucket
in which the q-th row lies, only that bucket is ranked, and the row found there
becomes a threshold that all other rows are compared with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.config import EXPERT_COLUMNS, DropoutSettings, SplitSettings
from quillmark.functions.hashing import row_hash, uniform
from quillmark.operators.corpus import label_stratum

BUCKET_BITS = 16


def quota_parts(
    df: DataFrame,
    keys: list[str],
    seed: int,
    salt: str,
    ends: Callable[[Column, Column, Column], list[Column]],
    label: str | None = None,
    name: str = "_part",
) -> DataFrame:
    """Number the rows of each class by quota, in hash order.

    ``ends(n, total, stratum)`` gives the running ends of the parts within a
    class of ``n`` rows out of ``total``. A row is in part 0 up to the first
    end, in part 1 up to the second, and so on; the rest get the last number.
    ``keys`` must be unique. There are at most two classes, so the thresholds
    are a handful of rows.
    """
    stratum = F.lit(0) if label is None else label_stratum(F.col(label))
    position = row_hash(keys, seed, salt)
    bucket = F.shiftright(F.col("_hash"), 32 - BUCKET_BITS)
    hashed = df.select(stratum.alias("_stratum"), position.alias("_hash"), *keys).withColumn(
        "_bucket", bucket
    )
    n_parts = len(ends(F.lit(0), F.lit(0), F.lit(0)))

    histogram = hashed.groupBy("_stratum", "_bucket").agg(F.count("*").alias("_count"))
    in_class = W.partitionBy("_stratum")
    running = in_class.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    histogram = histogram.select(
        "_stratum",
        "_bucket",
        (F.sum("_count").over(running) - F.col("_count")).alias("_before"),
        F.sum("_count").over(running).alias("_upto"),
        F.sum("_count").over(in_class).alias("_n"),
        F.sum("_count").over(W.partitionBy(F.lit(0))).alias("_total"),
    )
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("_i"), end.cast("bigint").alias("_end"))
            for i, end in enumerate(ends(F.col("_n"), F.col("_total"), F.col("_stratum")))
        ]
    )
    cuts = (
        histogram.select("_stratum", "_bucket", "_before", "_upto", F.inline(wanted))
        .filter((F.col("_end") > F.col("_before")) & (F.col("_end") <= F.col("_upto")))
        .select("_stratum", "_bucket", "_i", (F.col("_end") - F.col("_before")).alias("_rank"))
    )
    ranked = hashed.join(F.broadcast(cuts), ["_stratum", "_bucket"]).withColumn(
        "_row",
        F.row_number().over(
            W.partitionBy("_stratum", "_bucket", "_i").orderBy("_hash", *keys)
        ),
    )
    place = F.struct("_hash", *keys)
    thresholds = (
        ranked.filter(F.col("_row") == F.col("_rank"))
        .groupBy("_stratum")
        .agg(
            *[F.max(F.when(F.col("_i") == i, place)).alias(f"_t{i}") for i in range(n_parts)]
        )
    )
    own = F.struct(position.alias("_hash"), *keys)
    part = F.lit(n_parts)
    for i in reversed(range(n_parts)):
        # A null threshold means an empty part, so the comparison must be false.
        part = F.when(F.coalesce(own <= F.col(f"_t{i}"), F.lit(False)), F.lit(i)).otherwise(part)
    joined = df.withColumn("_stratum", stratum).join(F.broadcast(thresholds), "_stratum", "left")
    return joined.select(*[F.col(c) for c in df.columns], part.alias(name))


def split_ends(split: SplitSettings) -> Callable[[Column, Column, Column], list[Column]]:
    """Test first, rounded up; the rest is divided with train rounded down."""
    of_rest = split.train / (split.train + split.val) if split.train + split.val else 0.0

    def ends(n: Column, total: Column, stratum: Column) -> list[Column]:
        test = F.ceil(F.lit(float(split.test)) * n)
        return [test, test + F.floor((n - test) * F.lit(of_rest))]

    return ends


def split_rows(
    df: DataFrame,
    keys: list[str],
    split: SplitSettings | None = None,
    label: str | None = "label",
) -> DataFrame:
    """Add ``split``: train, val or test, with exact counts per class."""
    split = split or SplitSettings()
    label = label if split.stratify else None
    parts = quota_parts(df, keys, split.seed, "split", split_ends(split), label)
    names = F.when(F.col("_part") == 0, "test").when(F.col("_part") == 1, "train").otherwise("val")
    return parts.select(*df.columns, names.alias("split"))


def sample_rows(
    df: DataFrame, keys: list[str], n: int, seed: int = 42, label: str | None = "label"
) -> DataFrame:
    """Draw n rows; with a label, in proportion to the classes.

    Class 0 gets its share rounded down and class 1 the rest, each at most its
    size. Asking for all rows or more returns all.
    """

    def ends(size: Column, total: Column, stratum: Column) -> list[Column]:
        if label is None:
            return [F.least(F.lit(n), size)]
        share = F.lit(float(n)) * size / total
        # Class 1 gets what class 0 leaves, so its share is found from the other side.
        others = F.floor(F.lit(float(n)) * (total - size) / total)
        quota = F.when(stratum == 0, F.floor(share)).otherwise(F.lit(n) - others)
        return [F.when(F.lit(n) >= total, size).otherwise(F.least(quota, size))]

    parts = quota_parts(df, keys, seed, "sample", ends, label)
    return parts.filter(F.col("_part") == 0).select(*df.columns)


def meta_split(
    df: DataFrame, keys: list[str], validation: float = 0.15, seed: int = 42, label: str = "label"
) -> DataFrame:
    """Two parts per class: val rounded up, then train."""
    parts = quota_parts(
        df,
        keys,
        seed,
        "meta",
        lambda n, total, stratum: [F.ceil(F.lit(float(validation)) * n)],
        label,
    )
    names = F.when(F.col("_part") == 0, "val").otherwise("train")
    return parts.select(*df.columns, names.alias("split"))


def split_leakage(sentences: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents whose sentences fall into more than one split."""
    return (
        sentences.groupBy(key)
        .agg(F.size(F.collect_set("split")).alias("n_splits"), F.count("*").alias("n_sentences"))
        .filter(F.col("n_splits") > 1)
    )


def meta_training_set(
    train: DataFrame,
    val: DataFrame,
    keys: list[str],
    n: int,
    seed: int = 42,
    use_val: bool = True,
    label: str | None = "label",
) -> DataFrame:
    """Sampled train rows and, if wanted, every validation row."""
    sampled = sample_rows(train, keys, n, seed, label)
    return sampled.unionByName(val) if use_val else sampled


def expert_dropout(
    df: DataFrame,
    keys: list[str],
    dropout: DropoutSettings | None = None,
    experts: Iterable[str] = EXPERT_COLUMNS,
) -> DataFrame:
    """Set one expert of randomly chosen rows to a neutral value.

    ``concat`` keeps the rows as they are and adds a changed copy of all of
    them; ``replace`` changes them in place. Two hashes of the key decide
    whether a row is chosen and which expert it loses.
    """
    dropout = dropout or DropoutSettings()
    if dropout.mode not in ("concat", "replace"):
        raise ValueError(f"mode must be 'concat' or 'replace', got {dropout.mode!r}")
    present = [c for c in experts if c in df.columns]
    if not present:
        return df.withColumn("is_augmented", F.lit(False))
    if len(present) != len(dropout.weights):
        raise ValueError(f"dropout weights {dropout.weights} need as many experts, have {present}")

    chosen = uniform(keys, dropout.seed, "mask") < F.lit(float(dropout.rate))
    which = uniform(keys, dropout.seed, "which")
    total = float(sum(dropout.weights))
    bounds = [sum(dropout.weights[: i + 1]) / total for i in range(len(present))]
    lows = [0.0, *bounds[:-1]]
    changed = df.select(
        *[
            F.when(
                chosen
                & (which >= lows[present.index(c)])
                & (which < bounds[present.index(c)]),
                F.lit(float(dropout.neutral)),
            )
            .otherwise(F.col(c))
            .alias(c)
            if c in present
            else F.col(c)
            for c in df.columns
        ],
        F.lit(True).alias("is_augmented"),
    )
    if dropout.mode == "replace":
        return changed
    return df.withColumn("is_augmented", F.lit(False)).unionByName(changed)
