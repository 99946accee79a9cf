"""Every registered query of the engine against its SQL in DuckDB, on the smallest of the driver's tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from curatio.plans.catalog import ORACLES, QUERIES
from curatio.plans.coverage import TABLES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM '{SF_DIR}/{t}.parquet'")
    yield con
    con.close()


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, float) or hasattr(x, "quantize"):
        return round(float(x), 6)
    return x


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in frame.collect())
    if name not in ORACLES:
        assert got
        return
    answer = duck.execute(ORACLES[name])
    at = {d[0]: i for i, d in enumerate(answer.description)}
    assert sorted(at) == columns
    assert got == sorted(repr([plain(r[at[c]]) for c in columns]) for r in answer.fetchall())


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_blocked_joins_have_no_nested_loops(spark):
    for name in ("band_left_join", "lookup_tiers", "orphan_rows", "coverage_gaps"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
