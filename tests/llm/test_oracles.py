"""Queries against their SQL counterparts on the given tables."""

import duckdb
import pytest

from heatmart.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    found = con.execute(SQL[name])
    names = [d[0] for d in found.description]
    mine = QUERIES[name](spark, SMALL).select(*names)
    assert mine.columns == names
    assert sorted(map(tuple, mine.collect()), key=repr) == sorted(found.fetchall(), key=repr)
