"""Held-out accuracy and edge rows of the two document classifiers."""

import itertools

import numpy as np
import pytest

from quillmark.llm import quality, toxicity
from quillmark.llm.common import crc_fold, read
from tests.llm import edges

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("run, target, n, held", [(quality.op9_quality, "quality", 4, 2), (toxicity.op6_toxicity, "toxic", 3, 1)])
def test_held_out_accuracy(spark, run, target, n, held):
    truth = {r.doc_id: r[target] for r in read(spark, SF, "labels").collect()}
    rows = run(spark, SF).collect()
    assert len(rows) == read(spark, SF, "documents").count()
    assert all(r.held_out == (crc_fold(r.doc_id, n) == held) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    tested = [r for r in rows if r.held_out and r.doc_id in truth]
    right = np.mean([r.predicted == truth[r.doc_id] for r in tested])
    always = max(np.mean([truth[r.doc_id] == y for r in tested]) for y in (0, 1))
    assert right >= max(0.9, always)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edges(spark, module):
    docs, labels = edges.documents(spark), edges.labels(spark)
    model = module.train(docs, labels)
    rows = module.scores(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r, s in zip(sorted(docs.collect(), key=lambda r: str(r.doc_id)), sorted(rows, key=lambda r: str(r.doc_id))):
        if r.doc_id is not None:
            assert by_text.setdefault(r.text or "", s.score) == s.score
    kept = module.kept(docs, model)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert module.kept(edges.no_documents(spark), model).count() == 0
    none = module.train(docs, labels.where("doc_id = 1"))
    assert {round(r.score, 6) for r in module.scores(docs, none).collect()}.__len__() == 1


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    flipped = labels.selectExpr(
        "doc_id",
        "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 1 - quality, quality) AS quality",
        "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 3 = 1, 1 - toxic, toxic) AS toxic",
    )
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert np.allclose(a.weights, b.weights)
    assert toxicity.train(docs, labels) == toxicity.train(docs, flipped)


def test_marginals_are_those_of_all_labellings():
    chance = np.random.default_rng(2)
    transition = chance.normal(size=(2, 2))
    documents = [chance.normal(size=n) for n in (1, 4, 0, 6, 4)]
    found, expected = quality.marginals(documents, transition)
    pairs = np.zeros((2, 2))
    for scores, p in zip(documents, found):
        total, good = 0.0, np.zeros(len(scores))
        own = np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=len(scores)):
            weight = np.exp(sum(s for s, y in zip(scores, labels) if y) + sum(transition[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            good += weight * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                own[a, b] += weight
        if len(scores):
            assert np.allclose(p, good / total)
            pairs += own / total
    assert np.allclose(expected, pairs)


def test_insults_save_bytes_only_with_the_toxic_dictionary(spark):
    model = toxicity.train(read(spark, SF, "documents"), read(spark, SF, "labels"))
    model.open()
    plain = model.features("the and of with this that")
    assert plain[2] == 0
