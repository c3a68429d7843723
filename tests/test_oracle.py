"""Every registered query equals its DuckDB oracle on the smallest tables (exact values)."""

import os

import duckdb
import pytest

from tests.paths import SF_SMALL
from jobmart.plans.oracle import oracle_sql
from jobmart.plans.registry import queries
from tools.check_oracle import TABLES, rows_of

QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = duck.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(d_cols, res.fetchall())
