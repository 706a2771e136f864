"""Row positions, batch functions and table functions against plain Python."""

import random

import pytest

from quillmark.operators import batches
from quillmark.operators.batches import apply_batches, register_table_function, row_index
from quillmark.sources.staging import stage


@pytest.fixture
def table(spark):
    """A key with a third of all rows, nulls, and rows that repeat."""
    chance = random.Random(2)
    rows = [(chance.choice([None, 7, 7, 7, *range(20)]), chance.choice([None, "", "a", "b" * 50]), i // 2) for i in range(600)]
    return spark.createDataFrame(rows, "k int, part string, local int").repartition(5)


def test_positions_are_gapless_and_in_order(table):
    found = sorted(row_index(table, "k", "local").collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in found] == list(range(600))
    key = lambda r: (r.k is not None, r.k or 0, r.local)
    assert [key(r) for r in found] == sorted(map(key, table.collect()))
    assert sorted(map(str, ((r.k, r.part, r.local) for r in found))) == sorted(str(tuple(r)) for r in table.collect())


def test_a_common_key_falls_into_several_ranges(spark, monkeypatch):
    dealt = []

    def kept(df, name):
        dealt.append(stage(df, name))
        return dealt[0]

    monkeypatch.setattr(batches, "stage", kept)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = row_index(spark.range(20_000).selectExpr("IF(id % 3 = 0, 1, id) AS k", "id AS v"), "k").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sorted(r.row_index for r in found) == list(range(20_000))
    assert dealt[0].where("k = 1").select("__part").distinct().count() > 1


def test_empty_tables_and_taken_names(table):
    assert row_index(table.where("k > 99"), "k").count() == 0
    with pytest.raises(ValueError):
        row_index(table, "k", name="PART")
    with pytest.raises(ValueError):
        row_index(table)


def test_batches_get_their_positions(table):
    out = apply_batches(
        table, lambda batch, index: batch.assign(i=index)[["local", "i"]], "local int, i bigint", with_indices=True, order=["local"]
    ).collect()
    assert sorted(r.i for r in out) == list(range(600)) and all(r.local == r.i // 2 for r in out)


def test_table_function(spark, table):
    register_table_function(spark, "letters", lambda s: ((c,) for c in s or ""), "c string")
    counts = spark.sql("SELECT c, count(*) AS n FROM {t}, LATERAL letters(part) GROUP BY c", t=table).collect()
    texts = [r.part or "" for r in table.collect()]
    assert {r.c: r.n for r in counts} == {c: sum(t.count(c) for t in texts) for c in "ab"}
