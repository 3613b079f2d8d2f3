"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

import __spark_entry__ as contract
from envlake.plans import catalog
from envlake.plans.driver_tables import DriverTables

FOLDER = "/root/testdata/sf0.001"
PLANS = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(PLANS))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, PLANS[name], SQL[name]) > 0


def plan_of(spark, name):
    frame = catalog._PLANS[name](DriverTables(spark, FOLDER))
    return frame._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_all_are_registered():
    assert set(PLANS) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", [name for name in PLANS if not name.startswith(("stream_", "build_"))])
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rank_limit_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(spark, "location_recent20")


def test_marts_aggregate_numbers_by_hash(spark):
    plan = plan_of(spark, "agg_daily")
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_scan_reads_needed_columns_only(spark):
    plan = plan_of(spark, "avg_by_location")
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan
