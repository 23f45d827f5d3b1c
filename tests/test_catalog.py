"""The named queries against their SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shelfcast.catalog.queries import QUERIES
from check_queries import TABLES, compare
from conftest import plan_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    text, _, equal = compare(spark, con, FOLDER, name, queries()[name], oracle_sql()[name])
    assert equal, text


def test_entry(spark):
    assert entry(spark).count() == 27_175


def test_no_query_plans_a_nested_loop(spark):
    for name in ("mart_daily", "relevance_bridge", "spine", "event_features_decomposed", "policy_projection", "leak_scan"):
        plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_no_stage_over_data_is_a_single_task(spark):
    for name in ("spine", "event_features_decomposed", "relevance_bridge"):
        assert "Exchange SinglePartition" not in plan_of(queries()[name](spark, FOLDER)), name
