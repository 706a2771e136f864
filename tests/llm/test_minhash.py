import numpy as np
import pytest

from quillmark.llm import components, minhash
from quillmark.llm.common import read
from tests.llm import edges


def brute(rows, percent=75):
    """Components over all pairs of documents by exact shingle sets."""
    sets, out = {}, {}
    for r in rows:
        words = (r["text"] or "").encode().lower().split()
        n = max(1, len(words) - 4)
        found = frozenset(tuple(words[i : i + 5]) for i in range(n)) if words else frozenset()
        out.setdefault(r["doc_id"], len(found))
        if r["doc_id"] is not None and found:
            sets[r["doc_id"]] = found
    parent = {i: i for i in out}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (n, root(i)) for i, n in out.items()}


@pytest.mark.parametrize("source", ["table", "edges"])
def test_same_components_as_brute_force(spark, sf, source):
    docs = read(spark, sf, "documents") if source == "table" else edges.documents(spark)
    rows = minhash.near_duplicates(docs).collect()
    expected = brute(docs.collect())
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_many_near_copies_and_a_chain(spark):
    """A large group, a chain that no single document is like, and strangers in between."""
    words = [f"v{i}" for i in range(200)]
    rows = [(i, " ".join([*words[: i % 20], f"n{i}", *words[i % 20 + 1 :]])) for i in range(150)]
    rows += [(1000 + i, " ".join(f"c{j}" for j in range(5 * i, 5 * i + 60))) for i in range(12)]
    rows += [(2000 + i, " ".join(f"s{i}_{j}" for j in range(30))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert found == {i: c for i, (_, c) in brute([{"doc_id": i, "text": t} for i, t in rows]).items()}
    assert found[1011] == 1000


@pytest.mark.parametrize("cell", [minhash.CELL, 24])
def test_a_family_that_stays_unlinked_makes_no_pairs(spark, monkeypatch, cell):
    """Each two share a base and few are linked: a row for each node and band at most."""
    chance, rows = np.random.default_rng(3), []
    for i in range(200):
        words = [f"v{j}" for j in range(150)]
        for at in chance.choice(150, 3, replace=False):
            words[at] = f"n{i}_{at}"
        rows.append((i, " ".join(words)))
    sizes, kept = {}, minhash.stage

    def counted(df, name):
        out = kept(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(minhash, "stage", counted)
    monkeypatch.setattr(minhash, "CELL", cell)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert found == {i: c for i, (_, c) in brute([{"doc_id": i, "text": t} for i, t in rows]).items()}
    assert 1 < len(set(found.values())) < 200
    blocks = -(-200 // cell)
    assert max(sizes.values()) <= 200 * minhash.BANDS * blocks and sizes["links"] < 200


def test_empty_table(spark):
    assert minhash.near_duplicates(edges.no_documents(spark)).count() == 0


def test_signature_estimates_similarity():
    chance = np.random.default_rng(5)
    a = chance.integers(0, 2**63, 4000).astype(np.uint64)
    b = np.concatenate([a[:3200], chance.integers(0, 2**63, 800).astype(np.uint64)])
    same = (minhash.signature(np.unique(a)) == minhash.signature(np.unique(b))).mean()
    assert abs(same - 3200 / 4800) < 0.15


def test_components(spark):
    edges_ = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (105, 101)]
    df = spark.createDataFrame(edges_, "a bigint, b bigint")
    found = {r.node: r.component for r in components.components(df).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components.components(df.where("a < 0")).count() == 0


def test_rows_go_by_id_and_text(spark):
    """A text stays though its id is also that of a near copy; repeated rows leave one."""
    copy = " ".join(f"w{j}" for j in range(40))
    other, third = (" ".join(f"{c}{j}" for j in range(40)) for c in "ot")
    rows = [
        (1, copy, 0), (2, copy + " more", 0), (2, other, 0), (3, third, 0), (3, third, 1), (4, other + " x", 0),
        (5, copy, 0), (5, None, 0), (5, "", 0), (6, " ", 0), (None, copy, 0), (None, copy, 0), (7, third, 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component int")
    out = minhash.deduplicated(docs)
    assert out.schema == docs.schema
    found = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert found == sorted(
        [(1, copy), (2, other), (3, third), (5, None), (5, ""), (6, " "), (None, copy), (None, copy)], key=str
    )
    assert minhash.deduplicated(edges.no_documents(spark)).count() == 0


def test_one_row_of_a_group_under_one_id(spark):
    copy = " ".join(f"w{j}" for j in range(40))
    docs = spark.createDataFrame([(1, copy), (1, copy + " more"), (2, copy)], "doc_id bigint, text string")
    assert [r.doc_id for r in minhash.deduplicated(docs).collect()] == [1]
