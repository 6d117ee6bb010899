"""Every registered query that SQL can express equals its DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMOKE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMOKE)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(_norm(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall()), key=repr)
    assert got == want


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "visit_date" in df.columns
