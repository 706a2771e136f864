import numpy as np
import pytest

from quillmark.llm import nn_descent


def brute(rows, threshold=0.9):
    usable = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or any(c is None for c in v):
            continue
        x = np.array(v, float)
        if np.isfinite(x).all() and x.any():
            usable.setdefault(i, x / np.linalg.norm(x))
    ids = sorted(usable)
    links = {i: 0 for i, _ in rows}
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (links[i], root(i)) for i in parent}


def check(spark, rows):
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id bigint, embedding array<float>, label int, node int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = nn_descent.near_duplicates(df).collect()
    assert len(found) == len(rows)
    expected = brute(rows)
    for r in found:
        if r.vec_id is not None:
            assert (r.n_links, r.component_id) == expected[r.vec_id], r
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)


def test_groups_among_strangers(spark):
    chance = np.random.default_rng(1)
    vectors = [chance.normal(size=32) for _ in range(300)]
    for size in (2, 3, 40):
        centre = chance.normal(size=32)
        vectors += [centre + 0.12 * chance.normal(size=32) for _ in range(size)]
    vectors += [vectors[0]] * 5 + [3 * vectors[1]]
    order = chance.permutation(len(vectors))
    check(spark, [(int(i), [float(c) for c in vectors[k]]) for i, k in enumerate(order)])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, None]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0])]
    rows += [(9, [1.0, 0.0, 0.0]), (10, [0.0, 1.0]), (11, [1.0, 0.1]), (None, [1.0, 0.0])]
    check(spark, rows)


@pytest.mark.parametrize("n", [0, 1])
def test_hardly_any_rows(spark, n):
    df = spark.createDataFrame([(5, [1.0, 2.0])][:n], "vec_id bigint, embedding array<float>")
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in nn_descent.near_duplicates(df).collect()] == [(5, 0, 5, True)][:n]


def test_audit_counts_what_is_missing(spark):
    rows = [(100 * i, [1.0, 0.01 * i]) for i in range(6)]
    nodes = nn_descent.unit_nodes(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    none = spark.createDataFrame([], "a bigint, b bigint, cosine double")
    assert nn_descent.audit(none, nodes, 0.9) == 0.0


def pairs_and_a_group(n_background, n_pairs=300, n_group=300, d=64):
    chance = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)

    def near(x, low, high):
        c = chance.uniform(low, high, (len(x), 1))
        other = chance.normal(size=x.shape)
        other = unit(other - (other * x).sum(axis=1, keepdims=True) * x)
        return c * x + np.sqrt(1 - c * c) * other

    first = unit(chance.normal(size=(n_pairs, d)))
    centre = unit(chance.normal(size=(1, d)))
    group = near(np.repeat(centre, n_group, axis=0), 0.97, 0.99)
    return np.concatenate([first, near(first, 0.905, 0.93), group, unit(chance.normal(size=(n_background, d)))])


def as_table(spark, x):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def test_isolated_pairs_are_found_beside_a_large_group(spark):
    found = nn_descent.near_duplicates(as_table(spark, pairs_and_a_group(2000, n_group=60)))
    linked = {r.vec_id for r in found.where("n_links > 0").collect()}
    assert sum(i in linked and i + 300 in linked for i in range(300)) >= 294


def test_a_large_group_does_not_hide_lost_pairs(spark):
    x = pairs_and_a_group(200, n_pairs=50)
    nodes = nn_descent.unit_nodes(as_table(spark, x)).cache()
    by_id = {r.vec_id: r.node for r in nodes.collect()}
    pairs = [sorted((by_id[i], by_id[j])) for i in range(100, 400) for j in range(i + 1, 400)]
    links = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "a bigint, b bigint, cosine double")
    assert nn_descent.audit(links, nodes, 0.9) < 0.1


def test_codes_grow_with_the_nodes():
    assert [nn_descent.code_bits(n) - nn_descent.SPARE for n in (0, 2, 1 << 14, 1 << 20)] == [1, 1, 14, 20]


def test_an_id_with_a_usable_and_an_unusable_vector_keeps_both_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, None), (2, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    found = nn_descent.near_duplicates(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == [(1, 0, 1), (1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("block", [7, 40, 1000])
def test_links_of_groups_are_counted_across_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(nn_descent, "BLOCK", block)
    monkeypatch.setattr(nn_descent, "STRIPE", 5)
    chance = np.random.default_rng(5)
    sizes = [90, 12, 2, 2, 3]
    x = np.concatenate([chance.normal(size=(1, 16)) + 0.33 * chance.normal(size=(s, 16)) for s in sizes])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    group = np.repeat(np.arange(len(sizes)), sizes)
    copies = chance.integers(1, 4, len(x))
    rows = [(k, int(copies[k]), x[k].tobytes()) for k in range(len(x))]
    nodes = spark.createDataFrame(rows, "node bigint, n bigint, unit binary")
    groups = spark.createDataFrame([(k, int(g)) for k, g in enumerate(group)], "node bigint, component bigint")
    close = (x @ x.T >= 0.9) & (group[:, None] == group) & ~np.eye(len(x), dtype=bool)
    assert 0 < close[:90, :90].sum() < 90 * 89
    found = {r.node: (r.links, r.others) for r in nn_descent.group_links(groups, nodes, 0.9).collect()}
    assert found == {k: (int(close[k].sum()), int(close[k] @ copies)) for k in found}
    assert all(k in found for k in range(len(x)) if close[k].any())
