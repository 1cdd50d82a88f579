"""The operators that SQL can express, against their SQL on the smallest tables."""

import os

import pytest

from genoweave.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    rel = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in df.columns) for r in rel.fetchall()), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == want
