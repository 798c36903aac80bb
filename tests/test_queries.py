"""Every registered query against its SQL twin, and the shape of the plans."""

from __future__ import annotations

import pytest

from checks.compare import connect, differences
from checks.oracle import oracle
from checks.queries import registry


@pytest.fixture(scope="module")
def database(data):
    return connect(data)


def test_every_query_has_a_twin():
    assert set(registry()) == set(oracle())


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_equals_twin(spark, data, database, name):
    df = registry()[name](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert differences(df, database, oracle()[name]) is None


def plan_of(spark, data, name):
    return registry()[name](spark, data)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, data):
    plan = plan_of(spark, data, "user_journey")
    events = next(line for line in plan.splitlines() if "events.parquet" in line)
    assert "In(event_type, [click,purchase,view])" in events
    assert "value#" not in events and "event_id#" not in events


def test_ranking_is_cut_before_the_exchange(spark, data):
    assert plan_of(spark, data, "category_recs_scored").count("WindowGroupLimit") >= 2


def test_profile_scans_once_without_joining_aggregates(spark, data):
    plan = plan_of(spark, data, "customer_360_rank")
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Join") == 1


@pytest.mark.parametrize("name", ["category_performance", "brand_performance"])
def test_distinct_counts_read_events_once_and_exchange_groups(spark, data, name):
    lines = plan_of(spark, data, name).splitlines()
    assert sum("events.parquet" in line for line in lines if "FileScan" in line) == 1
    copies = [i for i, line in enumerate(lines) if "Expand" in line]
    above = [line for line in lines[: copies[0]] if "Project" not in line][-1]
    assert len(copies) == 1 and "functions=[partial_" in above, "copies are reduced in their task"
