"""Every catalogued query against its DuckDB oracle on the sf0.001 tables."""
import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, rows_of  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["segment", "num_orders", "total_sales", "avg_profit"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_rows_only():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    s_rows, s_cols = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    d_rows, d_cols = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
