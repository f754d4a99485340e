import os

import pytest

import __spark_entry__ as entry
from corpusgate.plans.oracle import ORACLE_SQL
from corpusgate.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


def plain(v):
    if v is None or v != v:
        return None
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_and_agrees_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    got = QUERIES[name](spark, SMALL)
    rows = got.collect()
    if name not in ORACLE_SQL:
        return
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW \"{f[:-8]}\" AS SELECT * FROM read_parquet('{SMALL}/{f}')")
    want = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda r: tuple(str(x) for x in r)
    a = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in rows), key=key)
    b = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in want.fetchall()), key=key)
    assert a == b


def test_entry_and_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_empty_tables(spark, empty_tables, name):
    QUERIES[name](spark, empty_tables).collect()
