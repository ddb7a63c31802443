"""Every survey query with SQL gives DuckDB's rows, at sf0.001."""

import os

import duckdb
import pytest

from plumbline.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{DATA}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    rows = [tuple(r) for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    if name not in ORACLES:
        assert rows
        return
    rel = duck.sql(ORACLES[name])
    cols = sorted(rel.columns)
    assert sorted(df.columns) == cols
    pick = lambda rs, names: sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in rs)
    assert pick(rows, df.columns) == pick(rel.fetchall(), rel.columns)
