import pytest

import __spark_entry__ as entry
from tests.comparing import connect, differences

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["language", "label"]


def test_every_statement_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, con, name):
    assert differences(entry.queries()[name](spark, sf), con, SQL[name]) == []


@pytest.mark.parametrize("name", ["expert_scores", "meta_scores"])
def test_scores_are_probabilities(spark, sf, name):
    rows = entry.queries()[name](spark, sf)
    names = [c for c in rows.columns if c.startswith("prob_")]
    bad = rows.filter(" or ".join(f"{c} is null or {c} not between 0 and 1" for c in names))
    assert rows.count() > 0 and bad.count() == 0
