"""Plan properties that matter at scale, checked on the physical plans of the registered queries."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from starloom.operators.validation import require_params
from tests.conftest import SF_SMALL

QUERIES = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_watermark_reaches_the_scan(spark):
    p = plan(QUERIES["watermark_extract"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_orderkey), Or(LessThanOrEqual(l_shipdate" in p


def test_change_window_bound_is_pushed(spark):
    p = plan(QUERIES["change_window"](spark, SF_SMALL))
    assert "LessThan(ts,2024-01-20T00:00)" in p


def test_dimension_lookups_are_broadcast(spark):
    p = plan(QUERIES["transaction_fact"](spark, SF_SMALL))
    assert "SortMergeJoin" not in p and p.count("BroadcastHashJoin") >= 4


def test_columns_are_pruned(spark):
    p = plan(QUERIES["change_window"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in p


def test_parameter_guard():
    with pytest.raises(ValueError, match="start_time must be earlier"):
        require_params(start_time=dt.datetime(2024, 2, 1), end_time=dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError, match="end_time is required"):
        require_params(start_time=dt.datetime(2024, 2, 1), end_time=None)
