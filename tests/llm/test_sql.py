"""Queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from stereobate.llm.queries import ORACLE_SQL, QUERIES


def norm(v):
    return "%.9g" % v if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df = QUERIES[name](spark, sf)
    mine = sorted(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    cur = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert mine == sorted(tuple(norm(r[names.index(c)]) for c in sorted(df.columns)) for r in cur.fetchall())
