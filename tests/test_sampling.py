import math

import pytest
from pyspark.sql import functions as F

from quillmark.config import DropoutSettings, SplitSettings
from quillmark.operators.corpus import check_labels, label_domain
from quillmark.operators.sampling import (
    expert_dropout,
    meta_split,
    meta_training_set,
    sample_rows,
    split_leakage,
    split_rows,
)


def corpus(spark, ones=70, zeros=30, partitions=3):
    n = ones + zeros
    return (
        spark.range(n)
        .select(F.col("id").alias("doc_id"), (F.col("id") < ones).cast("int").alias("label"))
        .repartition(partitions)
    )


def counts(df, *by):
    return {tuple(r[b] for b in by): r["count"] for r in df.groupBy(*by).count().collect()}


@pytest.mark.parametrize("ones, zeros", [(70, 30), (7, 3), (1, 1), (501, 1)])
def test_split_quotas_are_exact_per_class(spark, ones, zeros):
    got = counts(split_rows(corpus(spark, ones, zeros), ["doc_id"]), "label", "split")
    for label, n in ((1, ones), (0, zeros)):
        test = math.ceil(0.1 * n)
        train = math.floor((n - test) * (0.8 / 0.9))
        wanted = {"test": test, "train": train, "val": n - test - train}
        assert {s: got.get((label, s), 0) for s in wanted} == wanted


def test_split_does_not_depend_on_partitioning(spark):
    one = {tuple(r) for r in split_rows(corpus(spark, partitions=1), ["doc_id"]).collect()}
    many = {tuple(r) for r in split_rows(corpus(spark, partitions=17), ["doc_id"]).collect()}
    assert one == many


def test_unstratified_split(spark):
    got = counts(split_rows(corpus(spark), ["doc_id"], SplitSettings(stratify=False)), "split")
    assert got == {("test",): 10, ("train",): 80, ("val",): 10}


def test_empty_parts(spark):
    split = SplitSettings(train=1.0, val=0.0, test=0.0)
    assert counts(split_rows(corpus(spark), ["doc_id"], split), "split") == {("train",): 100}


def test_fractions_must_sum_to_one():
    with pytest.raises(ValueError):
        SplitSettings(train=0.5, val=0.1, test=0.1)


@pytest.mark.parametrize("n", [0, 1, 10, 33, 99, 100, 500])
def test_sample_sizes(spark, n):
    got = counts(sample_rows(corpus(spark), ["doc_id"], n), "label")
    if n >= 100:
        assert got == {(0,): 30, (1,): 70}
    else:
        zeros = int(n * 30 / 100)
        assert (got.get((0,), 0), got.get((1,), 0)) == (zeros, n - zeros)


def test_plain_sample(spark):
    assert sample_rows(corpus(spark), ["doc_id"], 13, label=None).count() == 13


def test_two_column_keys_and_leakage(spark):
    rows = spark.range(40).select(
        F.lit("d").alias("doc_id"), F.col("id").alias("sentence_index"), F.lit(1).alias("label")
    )
    split = split_rows(rows, ["doc_id", "sentence_index"])
    assert split_leakage(split).first().n_splits == 3
    assert meta_split(rows, ["doc_id", "sentence_index"]).filter("split = 'val'").count() == 6


def test_meta_training_set_keeps_all_of_val(spark):
    rows = corpus(spark)
    both = meta_training_set(rows, rows, ["doc_id"], 10)
    assert both.count() == 110


def scores(spark, n=400):
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.lit(0.1).alias("prob_ai_s1"),
        F.lit(0.2).alias("prob_ai_s3"),
        F.lit(0.3).alias("prob_ai_s5"),
    )


@pytest.mark.parametrize("rate, low, high", [(0.0, 0, 0), (0.3, 80, 160), (1.0, 400, 400)])
def test_dropout_changes_at_most_one_expert(spark, rate, low, high):
    out = expert_dropout(scores(spark), ["doc_id"], DropoutSettings(rate=rate)).collect()
    assert len(out) == 800
    first = [r for r in out if not r.is_augmented]
    assert all((r.prob_ai_s1, r.prob_ai_s3, r.prob_ai_s5) == (0.1, 0.2, 0.3) for r in first)
    changed = [
        sum(v == 0.5 for v in (r.prob_ai_s1, r.prob_ai_s3, r.prob_ai_s5)) for r in out if r.is_augmented
    ]
    assert max(changed) <= 1 and low <= sum(changed) <= high
    if rate == 1.0:
        s5 = sum(r.prob_ai_s5 == 0.5 for r in out)
        assert 160 < s5 < 240


def test_dropout_replace_and_missing_experts(spark):
    out = expert_dropout(scores(spark), ["doc_id"], DropoutSettings(mode="replace", rate=1.0))
    assert out.count() == 400
    plain = expert_dropout(scores(spark).select("doc_id"), ["doc_id"])
    assert plain.count() == 400 and plain.columns == ["doc_id", "is_augmented"]
    with pytest.raises(ValueError):
        expert_dropout(scores(spark).drop("prob_ai_s1"), ["doc_id"])
    with pytest.raises(ValueError):
        expert_dropout(scores(spark), ["doc_id"], DropoutSettings(mode="other"))


def test_label_checks(spark):
    good = spark.createDataFrame([(0,), (1,)], "label int")
    check_labels(good)
    check_labels(good.select(F.col("label").cast("boolean").alias("label")))
    for bad in ("label int", "label string"):
        rows = [(2,), (None,)] if "int" in bad else [("1",)]
        with pytest.raises(ValueError):
            check_labels(spark.createDataFrame(rows, bad))
    domain = {r.label: r.valid for r in label_domain(spark.createDataFrame([(0,), (3,), (None,)], "label int")).collect()}
    assert domain == {0: True, 3: False, None: False}


def test_bad_label_stops_a_split(spark):
    bad = spark.createDataFrame([(1, 5)], "doc_id int, label int")
    with pytest.raises(Exception, match="label is not 0 or 1"):
        split_rows(bad, ["doc_id"]).collect()
