"""Every query against its SQL in DuckDB on the smallest tables."""

import decimal
import math

import duckdb
import pytest

from stereobate import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, (int, float)):
        return "nan" if v != v else "%.9g" % (v or 0) if math.isfinite(v) else str(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return str(v)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    mine = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    theirs = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_sql_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0
