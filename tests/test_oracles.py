"""Every registered query against its DuckDB oracle on the smallest tables."""

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as entry

_spec = importlib.util.spec_from_file_location(
    "check_oracles", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "check_oracles.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)

KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in check.TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, duck, key):
    sdf = entry.queries()[key](spark, sf_small)
    s_rows, s_cols = [tuple(r) for r in sdf.collect()], list(sdf.columns)
    rel = duck.sql(entry.oracle_sql()[key])
    d_cols, d_rows = list(rel.columns), rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert check.digest(s_rows, s_cols) == check.digest(d_rows, d_cols)


def test_every_query_has_an_oracle():
    own = {k for k in entry.queries() if k not in entry.LLM_QUERIES}
    # what a fitted model says is no SQL: its figures are held against the labels in test_models
    assert own - {"model_metrics"} <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 280
    assert "eps_status" in df.columns
