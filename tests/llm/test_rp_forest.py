import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmark.llm import rp_forest
from quillmark.llm.common import read

SCHEMA = "vec_id bigint, embedding array<float>, label int, node int, rank int, score double"


def usable(v):
    return v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)


def brute(rows, every, k=20):
    """Exact lists; a query is an (id, vector) pair, and so is a candidate."""
    points = sorted({(i, tuple(c + 0.0 for c in v)) for i, v in rows if i is not None and usable(v)})
    out = []
    for q in points:
        if q[0] % every:
            continue
        scored = []
        for p in points:
            if p != q:
                n = min(len(p[1]), len(q[1]))
                scored.append((-math.fsum(a * b for a, b in zip(p[1][:n], q[1][:n])), p[0]))
        out += [(q[0], rank + 1, i, -cost) for rank, (cost, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 0.5) for i, v in rows], SCHEMA)


def found(spark, rows, every=20, k=20):
    df = rp_forest.nearest(frame(spark, rows), F.col("vec_id") % every == 0, k)
    assert df.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def same(ours, theirs):
    assert [x[:3] for x in ours] == [x[:3] for x in theirs]
    assert np.allclose([x[3] for x in ours], [x[3] for x in theirs], rtol=1e-13, atol=1e-13)


def whole(values):
    return [float(x) for x in values]


def test_everything_opened_is_brute_force(spark, monkeypatch):
    """Whole-number vectors tie often and have exact scores; blocks are far smaller than leaves."""
    monkeypatch.setattr(rp_forest, "RECALL", 1.0)
    monkeypatch.setattr(rp_forest, "LEAF", 40)
    monkeypatch.setattr(rp_forest, "BLOCK", 16)
    monkeypatch.setattr(rp_forest, "QUERY_BLOCK", 8)
    monkeypatch.setattr(rp_forest, "AUDIT", 10_000)
    chance = np.random.default_rng(2)
    rows = [(k, whole(chance.integers(-3, 4, 6))) for k in range(500)]
    rows += [(500 + k, [1.0, 2.0, 0.0, 1.0, 0.0, 3.0]) for k in range(200)]  # copies
    rows += [(700 + k, whole(np.array([3, 1, 0, 0, 2, 1]) + (chance.random(6) < 0.2))) for k in range(200)]
    same(found(spark, rows, 4), brute(rows, 4))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, -0.0], [nan, 1.0], [1.0, None], [inf, 1.0]]
    rows = [(20 * k, v) for k, v in enumerate(bad, 1)]
    rows += [(None, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [2.0, 0.0]), (140, [1.0, -0.0]), (7, [1.0, 5.0, 9.0]), (-20, [0.0, -1.0])]
    same(found(spark, rows), brute(rows, 20))
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_double_vectors(spark):
    chance = np.random.default_rng(4)
    rows = [(k, whole(chance.normal(size=5))) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    ours = sorted(tuple(r) for r in rp_forest.nearest(df, F.col("vec_id") % 20 == 0, 7).collect())
    same(ours, brute(rows, 20, 7))


@pytest.mark.parametrize("kind", ["random", "clusters"])
def test_recall(spark, sf, monkeypatch, kind):
    monkeypatch.setattr(rp_forest, "LEAF", 64)
    chance = np.random.default_rng(6)
    if kind == "random":
        rows = [(r.vec_id, r.embedding) for r in read(spark, sf, "embeddings").collect()]
    else:
        centres = chance.normal(size=(40, 24))
        rows = [(k, whole((centres[k % 40] + 0.3 * chance.normal(size=24)) * (1 + k % 3))) for k in range(2000)]
    exact = {(q, i) for q, _, i, _ in brute(rows, 5)}
    ours = found(spark, rows, 5)
    assert len(ours) == len(exact)
    assert len(exact & {(q, i) for q, _, i, _ in ours}) >= 0.9 * len(exact)


def test_queue_order_and_structure():
    """Leaves come with growing worst margin, each once; structured data needs few of them."""
    chance = np.random.default_rng(8)
    centres = chance.normal(size=(64, 16))
    x = centres[chance.integers(0, 64, 4000)] + 0.05 * chance.normal(size=(4000, 16))
    forest = rp_forest.Forest(x, float((x * x).sum(1).max()), 6)
    places = forest.places(x)
    near = 0
    for j in range(0, 4000, 100):
        order = forest.order(x[j], forest.leaves)
        assert sorted(order) == list(range(forest.leaves))
        true = np.argsort(-(x @ x[j]))[:20]
        near += np.isin(places[true], order[:16]).any(axis=1).mean() / 40
    assert near > 0.9
    counts = np.bincount(places.ravel(), minlength=forest.leaves)
    assert counts.min() >= 30 and counts.max() <= 100
