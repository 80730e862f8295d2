"""Every registered query with an oracle SQL matches DuckDB on the same tables (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, s_rows) == rows_of(rel.columns, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.schema == E.entry(spark).schema
