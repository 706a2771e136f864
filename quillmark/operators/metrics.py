"""Evaluation as one-pass aggregations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.config import EXPERT_COLUMNS

AUC_BINS = 1_000_000
#: Log odds beyond this share the outermost bins.
LOG_ODDS = 40.0
OUTCOMES = ("tp", "fp", "fn", "tn")


def decide(probability: Column, threshold: float = 0.5) -> Column:
    return (probability >= F.lit(float(threshold))).cast("int")


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _outcomes(label: Column, pred: Column, positive: int = 1) -> dict[str, Column]:
    yes, said = label == positive, pred == positive
    return {
        "tp": _count(yes & said),
        "fp": _count(~yes & said),
        "fn": _count(yes & ~said),
        "tn": _count(~yes & ~said),
    }


def _summed() -> list[Column]:
    return [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in OUTCOMES]


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _scores(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
    }


def _as_columns(values: dict[str, Column]) -> list[Column]:
    return [v.alias(k) for k, v in values.items()]


def classification_metrics(
    df: DataFrame, label: str = "label", pred: str = "pred", by: tuple[str, ...] = ()
) -> DataFrame:
    """Accuracy, F1, precision and recall of class 1; a zero division gives 0."""
    counted = df.groupBy(*by).agg(*_as_columns(_outcomes(F.col(label), F.col(pred))))
    scores = _scores(*[F.col(c) for c in OUTCOMES])
    return counted.select(
        *by, (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"), *_as_columns(scores)
    )


def metrics_per_language(
    df: DataFrame, label: str = "label", pred: str = "pred", language: str = "language"
) -> DataFrame:
    """The metrics of each language and, as ``all``, of every row together.

    A table without a language column gives no rows.
    """
    if language not in df.columns:
        empty = df.select(F.lit("all").alias("language"), label, pred).filter(F.lit(False))
        return classification_metrics(empty, label, pred, ("language",))
    counted = df.groupBy(F.col(language).alias("language")).agg(
        *_as_columns(_outcomes(F.col(label), F.col(pred)))
    )
    counted = counted.unionByName(
        counted.agg(*_summed()).select(F.lit("all").alias("language"), *OUTCOMES)
    )
    return counted.select(
        "language",
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"),
        *_as_columns(_scores(*[F.col(c) for c in OUTCOMES])),
    )


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", by: tuple[str, ...] = ()
) -> DataFrame:
    """Exact area under the ROC curve, null when a class is missing.

    Rows shrink to one per distinct score first. Scores are then ranked inside
    narrow bins in parallel, and only the bin totals (at most ``AUC_BINS`` per
    group) are added up in order. Ties count one half. The arithmetic is in
    whole numbers: twice the number of won pairs.
    """
    per_score = (
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("_score"))
        .agg(
            _count(F.col(label) == 1).alias("_pos"),
            _count(F.col(label) == 0).alias("_neg"),
        )
    )
    return _auc(per_score, by)


def auc_bin(score: Column) -> Column:
    """A bin that never falls as the score rises.

    Classifiers crowd their scores near 0 and 1; log odds spread them over the bins.
    """
    in_range = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    odds = F.when(in_range == 0, -LOG_ODDS).when(in_range == 1, LOG_ODDS)
    odds = odds.otherwise(F.ln(in_range / (1 - in_range)))
    place = F.least(F.greatest(odds, F.lit(-LOG_ODDS)), F.lit(LOG_ODDS)) / (2 * LOG_ODDS) + 0.5
    return F.floor(place * AUC_BINS)


def _auc(per_score: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """AUC from rows (by, _score, _pos, _neg) with distinct scores per group."""
    amount = "decimal(18,0)"
    per_score = per_score.select(
        *by, "_score", F.col("_pos").cast(amount).alias("_pos"), F.col("_neg").cast(amount).alias("_neg")
    )
    per_score = per_score.withColumn("_bin", auc_bin(F.col("_score")))
    below = W.partitionBy(*by, "_bin").orderBy("_score").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast(amount)
    per_bin = (
        per_score.withColumn(
            "_below", F.coalesce(F.sum("_neg").over(below), zero).cast(amount)
        )
        .groupBy(*by, "_bin")
        .agg(
            F.sum(F.col("_pos") * (F.col("_below") + F.col("_below") + F.col("_neg"))).alias("_won"),
            F.sum("_pos").cast(amount).alias("_pos"),
            F.sum("_neg").cast(amount).alias("_neg"),
        )
    )
    order = W.partitionBy(*(by or (F.lit(0),))).orderBy("_bin").rowsBetween(
        W.unboundedPreceding, -1
    )
    totals = (
        per_bin.withColumn("_below", F.coalesce(F.sum("_neg").over(order), zero).cast(amount))
        .groupBy(*by)
        .agg(
            (
                F.sum(F.col("_won").cast("decimal(38,0)"))
                + F.sum(F.col("_pos") * (F.col("_below") + F.col("_below")))
            )
            .cast("double")
            .alias("_won"),
            F.sum("_pos").cast("double").alias("_pos"),
            F.sum("_neg").cast("double").alias("_neg"),
        )
    )
    return totals.select(
        *by,
        F.try_divide(F.col("_won"), F.lit(2.0) * F.col("_pos") * F.col("_neg")).alias("roc_auc"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """All four cells, also those without rows."""
    cells = df.agg(*_as_columns(_outcomes(F.col(label), F.col(pred))))
    rows = [
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("pred"), F.col(c).alias("n"))
        for y, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ]
    return cells.select(F.inline(F.array(*rows)))


def class_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""
    tp, fp, fn, tn = (F.col(c) for c in OUTCOMES)
    counted = df.agg(*_as_columns(_outcomes(F.col(label), F.col(pred))))
    sides = {"0": (tn, fn, fp, tp), "1": (tp, fp, fn, tn)}
    per_class = {}
    for name, (hit, wrong, missed, rest) in sides.items():
        scores = _scores(hit, wrong, missed, rest)
        per_class[name] = [scores["precision"], scores["recall"], scores["f1"], hit + missed]
    support = [values[3] for values in per_class.values()]
    n = support[0] + support[1]
    names = ("precision", "recall", "f1")
    macro = [sum(v[i] for v in per_class.values()) / F.lit(2.0) for i in range(3)]
    weighted = [
        _ratio(sum(v[i] * v[3] for v in per_class.values()), n) for i in range(3)
    ]
    rows = {
        **per_class,
        "macro avg": [*macro, n],
        "weighted avg": [*weighted, n],
    }
    structs = [
        F.struct(
            F.lit(name).alias("class"),
            *[v.alias(c) for v, c in zip(values, (*names, "support"))],
        )
        for name, values in rows.items()
    ]
    return counted.select(F.inline(F.array(*structs)))


def stack_scores(df: DataFrame, models: dict[str, str], keep: tuple[str, ...]) -> DataFrame:
    """One row per model and input row: ``model``, ``score`` and the kept columns."""
    entries = [
        F.struct(F.lit(name).alias("model"), F.col(column).cast("double").alias("score"))
        for name, column in models.items()
    ]
    return df.select(*keep, F.inline(F.array(*entries)))


def evaluate_models(
    df: DataFrame,
    models: dict[str, str],
    label: str = "label",
    language: str = "language",
    threshold: float = 0.5,
) -> DataFrame:
    """Metrics, AUC and confusion counts of several score columns.

    One row per model for everything together (language ``all``) and one per
    model and language. AUC is only given for everything together.
    """
    has_language = language in df.columns
    keep = (label, language) if has_language else (label,)
    tall = stack_scores(df, models, keep)
    by = ["model", language] if has_language else ["model"]
    # Both results come from the same counts, so the rows are read and
    # shuffled once.
    counts = tall.groupBy(*by, F.col("score").alias("_score")).agg(
        _count(F.col(label) == 1).alias("_pos"), _count(F.col(label) == 0).alias("_neg")
    )
    said = F.coalesce(decide(F.col("_score"), threshold) == 1, F.lit(False))
    sums = {
        "tp": F.sum(F.when(said, F.col("_pos"))),
        "fp": F.sum(F.when(said, F.col("_neg"))),
        "fn": F.sum(F.when(~said, F.col("_pos"))),
        "tn": F.sum(F.when(~said, F.col("_neg"))),
    }
    sums = [F.coalesce(v, F.lit(0)).alias(k) for k, v in sums.items()]
    found = counts.groupBy(*by).agg(*sums)
    overall = found.groupBy("model").agg(*_summed()).withColumn("language", F.lit("all"))
    if has_language:
        overall = found.withColumnRenamed(language, "language").unionByName(overall)
    metrics = overall.select(
        "model", "language", *OUTCOMES, *_as_columns(_scores(*[F.col(c) for c in OUTCOMES]))
    )
    # Null scores count nothing here. A filter would be pushed below the counts, which
    # would then be made twice.
    known = F.col("_score").isNotNull().cast("bigint")
    distinct = counts.groupBy("model", "_score").agg(
        F.sum(F.col("_pos") * known).alias("_pos"), F.sum(F.col("_neg") * known).alias("_neg")
    )
    auc = _auc(distinct, ("model",)).withColumn("language", F.lit("all"))
    return metrics.join(auc, ["model", "language"], "left")


def flip_rates(
    df: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    experts: tuple[str, ...] = EXPERT_COLUMNS,
    neutral: float = 0.5,
    threshold: float = 0.5,
) -> DataFrame:
    """Share of decisions that change when one expert is made neutral.

    ``score`` adds a probability column ``_p``. Each row is scored once as it
    is and once per expert, all in the same pass. An absent expert has rate 0.
    """
    scored = score(df)
    scored = scored.withColumn("_base", decide(F.col("_p"), threshold)).drop("_p")
    rates = []
    for expert in experts:
        name = f"{expert.rsplit('_', 1)[-1]}_flip_rate"
        if expert not in df.columns:
            rates.append(F.lit(0.0).alias(name))
            continue
        changed = scored.withColumn("_kept", F.col(expert)).withColumn(
            expert, F.lit(float(neutral))
        )
        flipped = (decide(F.col("_p"), threshold) != F.col("_base")).cast("int")
        scored = (
            score(changed)
            .withColumn(f"_flip_{expert}", flipped)
            .withColumn(expert, F.col("_kept"))
            .drop("_p", "_kept")
        )
        rates.append(
            F.coalesce(F.sum(f"_flip_{expert}") / F.count(f"_flip_{expert}"), F.lit(0.0)).alias(name)
        )
    return scored.agg(*rates)
