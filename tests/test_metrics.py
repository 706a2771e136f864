import random

import pytest
from pyspark.sql import functions as F

from quillmark.operators import metrics
from quillmark.operators.corpus import class_balance, corpus_counts
from quillmark.operators.metrics import (
    class_report,
    classification_metrics,
    confusion_matrix,
    evaluate_models,
    flip_rates,
    metrics_per_language,
    roc_auc,
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, pred int, score double, language string")


def pairwise(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("case", ["random", "ties", "narrow", "outside", "one class", "all equal"])
def test_auc_is_the_pairwise_share(spark, case):
    rng = random.Random(7)
    draw = {
        "random": rng.random,
        "ties": lambda: rng.choice([0.1, 0.5, 0.9]),
        "narrow": lambda: 0.5 + rng.random() * 1e-9,
        "outside": lambda: rng.gauss(0, 3),
        "one class": rng.random,
        "all equal": lambda: 0.25,
    }[case]
    rows = [(1 if case == "one class" else rng.randint(0, 1), draw()) for _ in range(200)]
    got = roc_auc(spark.createDataFrame(rows, "label int, score double")).first()[0]
    wanted = pairwise(rows)
    assert got == wanted if wanted is None else abs(got - wanted) < 1e-12


def test_auc_ignores_partitioning_and_groups(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randint(0, 1), round(rng.random(), 2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "model string, label int, score double")
    got = {r.model: r.roc_auc for r in roc_auc(df.repartition(13), by=("model",)).collect()}
    for m in "ab":
        assert abs(got[m] - pairwise([(y, s) for n, y, s in rows if n == m])) < 1e-12


@pytest.mark.parametrize(
    "pairs, accuracy, f1, precision, recall",
    [
        ([(1, 1), (0, 0)], 1.0, 1.0, 1.0, 1.0),
        ([(1, 0), (0, 1)], 0.0, 0.0, 0.0, 0.0),
        ([(1, 0), (0, 0)], 0.5, 0.0, 0.0, 0.0),
        ([(1, 1), (1, 0), (0, 1), (0, 0)], 0.5, 0.5, 0.5, 0.5),
    ],
)
def test_metrics(spark, pairs, accuracy, f1, precision, recall):
    row = classification_metrics(frame(spark, [(y, p, 0.0, "en") for y, p in pairs])).first()
    assert (row.accuracy, row.f1, row.precision, row.recall) == (accuracy, f1, precision, recall)


def test_empty_confusion_cells_are_shown(spark):
    cells = confusion_matrix(frame(spark, [(1, 1, 0.9, "en")])).collect()
    assert {(r.label, r.pred): r.n for r in cells} == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_class_report(spark):
    rows = [(1, 1, 0.0, "en")] * 3 + [(0, 1, 0.0, "en")] + [(0, 0, 0.0, "en")] * 2
    got = {r["class"]: r for r in class_report(frame(spark, rows)).collect()}
    assert got["1"].precision == 0.75 and got["0"].recall == 2 / 3
    assert got["macro avg"].support == 6
    assert abs(got["weighted avg"].f1 - (got["0"].f1 * 3 + got["1"].f1 * 3) / 6) < 1e-12


def test_metrics_per_language(spark):
    df = frame(spark, [(1, 1, 0.0, "en"), (0, 1, 0.0, "de")])
    got = {r.language: r.accuracy for r in metrics_per_language(df).collect()}
    assert got == {"en": 1.0, "de": 0.0, "all": 0.5}
    assert metrics_per_language(df.drop("language")).count() == 0


def test_evaluate_models_without_language(spark):
    df = spark.createDataFrame([(1, 0.9, 0.2), (0, 0.1, 0.8)], "label int, a double, b double")
    got = {r.model: (r.accuracy, r.roc_auc) for r in evaluate_models(df, {"a": "a", "b": "b"}).collect()}
    assert got == {"a": (1.0, 1.0), "b": (0.0, 0.0)}


def test_flip_rates(spark):
    df = spark.createDataFrame([(0.9, 0.1), (0.4, 0.2)], "prob_ai_s1 double, prob_ai_s3 double")

    def score(rows):
        return rows.withColumn("_p", F.col("prob_ai_s1"))

    row = flip_rates(df, score).first()
    # A neutral 0.5 counts as class 1, so only the second row flips.
    assert (row.s1_flip_rate, row.s3_flip_rate, row.s5_flip_rate) == (0.5, 0.0, 0.0)


def test_counts_and_balance(spark):
    rows = spark.createDataFrame(
        [("a", 0, "train"), ("a", 1, "train"), ("b", 0, "test"), ("a", 2, "test")],
        "doc_id string, sentence_index int, split string",
    )
    got = {r.split: (r.texts, r.sentences) for r in corpus_counts(rows).collect()}
    assert got == {"train": (1, 2), "test": (2, 2), "all": (2, 4)}
    shares = class_balance(spark.createDataFrame([(1,), (1,), (0,), (1,)], "label int")).collect()
    assert {r.label: r.share for r in shares} == {1: 0.75, 0: 0.25}


def test_crowded_scores_use_many_bins(spark):
    rows = spark.range(20_000).select(
        (F.col("id") * 1e-12).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("label")
    )
    bins = metrics.auc_bin(F.col("score"))
    assert rows.select(bins.alias("b")).distinct().count() > 5000
    positives = [i for i in range(20_000) if i % 3 == 0]
    won = sum(i - k for k, i in enumerate(positives))
    expected = won / (len(positives) * (20_000 - len(positives)))
    assert metrics.roc_auc(rows).first().roc_auc == pytest.approx(expected, abs=1e-12)


def test_rows_are_counted_once_for_metrics_and_auc(spark):
    rows = spark.range(100).select((F.col("id") % 2).cast("int").alias("label"), (F.col("id") / 100).alias("a"))
    got = metrics.evaluate_models(rows.withColumn("b", F.when(rows.a > 0.5, rows.a)), {"a": "a", "b": "b"})
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Generate ") + final.count("Generate(") <= 1 or "ReusedExchange" in final
