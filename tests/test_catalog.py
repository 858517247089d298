import os

import duckdb
import pytest

from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((repr(tuple(r[i] for i in at)) for r in cur.fetchall()))
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == want
