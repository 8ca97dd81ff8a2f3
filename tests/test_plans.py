"""Filters and column pruning reach the Parquet scans (plan inspection only, nothing executed)."""

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _plan(spark, name):
    return entry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_peak_departures_prunes_and_pushes_down(spark):
    plan = _plan(spark, "peak_departures")
    assert "EqualTo(event_type,view)" in plan
    assert "props" not in plan and "value" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_station_filter_reaches_the_dimension_scan(spark):
    plan = _plan(spark, "latest_arrival_delay")
    assert "EqualTo(s_name,Supplier#000000007)" in plan
    assert "EqualTo(l_linestatus,F)" in plan


def test_graph_window_is_pushed_to_the_scan(spark):
    plan = _plan(spark, "graph_edges")
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan and "LessThan(ts,2024-02-01T00:00)" in plan
