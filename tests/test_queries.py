"""Every query with SQL gives DuckDB's rows; the rest run."""

import duckdb
import pytest

import __spark_entry__ as entry
from foliograph.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def compare(got_df, con, sql):
    names = sorted(got_df.columns)
    got = sorted(tuple(cell(v) for v in r) for r in got_df.select(*[f"`{n}`" for n in names]).collect())
    cur = con.execute(sql)
    have = [c[0] for c in cur.description]
    assert sorted(have) == names
    want = sorted(tuple(cell(r[have.index(n)]) for n in names) for r in cur.fetchall())
    assert got == want


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_query(spark, duck, key):
    df = catalog.queries()[key](spark, SF)
    if key in catalog.oracle_sql():
        compare(df, duck, catalog.oracle_sql()[key])
    else:
        got = df.collect()
        assert got and len(got[0]) == len(df.columns)


def test_entry(spark):
    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
