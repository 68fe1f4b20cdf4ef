"""Every registered query against its DuckDB twin on the smallest test data,
plus the driver entry point."""

from __future__ import annotations

import importlib.util
import os

import duckdb
import pytest

from marketlens.registry import ORACLE, QUERIES
from marketlens.sources.testdata import DRIVER_TABLES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def _tool():
    spec = importlib.util.spec_from_file_location("oracle_check", os.path.join(ROOT, "tools", "oracle_check.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, duck, name):
    tool = _tool()
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert tool.table_hash(df.columns, srows)[0] == tool.table_hash(dcols, drows)[0]


def test_entry_smoke(spark):
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() >= 0 and df.columns[:2] == ["year", "month"]
    assert set(mod.oracle_sql()) <= set(mod.queries())
