"""The registered queries against their SQL in another engine."""

import pytest

import __spark_entry__ as entry
from checks.catalog import QUERIES
from checks.compare import compare, connect
from checks.oracles import SQL
from support import plan


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["annee", "jours_sup_30", "jours_sup_35", "jours_sup_40",
                          "depts_touches_35"] and df.count() > 0


def no_slow_operator(df):
    text = plan(df)
    for word in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert word not in text, word


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir, no_slow_operator).startswith("ok")
