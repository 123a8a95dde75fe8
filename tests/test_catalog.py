"""Every registered query against DuckDB, on the smallest data directory."""

import pytest

import __spark_entry__ as entry_points
from caudal.queries.catalog import QUERIES
from caudal.queries.oracle import ORACLE
from compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert differences(df, connection, entry_points.oracle_sql()[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "tasa_mora_pct" in df.columns


def test_filter_and_columns_reach_the_scan(spark):
    df = entry_points.queries()["incremental_scan"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan
    assert "o_orderpriority" not in plan


def test_checks_read_only_their_columns(spark):
    df = entry_points.queries()["check_duplicate_keys"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_linenumber" in plan and "l_extendedprice" not in plan
