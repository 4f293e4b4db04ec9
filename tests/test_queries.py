"""Every registered query against its DuckDB oracle on the smallest driver tables
(row count, column names, order-insensitive value hash) — the driver's check in small."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, frame_hash  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(sp.columns) > 0
        return
    dd = con.sql(ORACLES[name]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert frame_hash(sp) == frame_hash(dd)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["page_id", "path", "title", "text", "length"]
