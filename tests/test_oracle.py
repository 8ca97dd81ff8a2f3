"""Every registered query equals its DuckDB twin on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from railyard.plans import catalog
from scripts.compare_oracle import canonical, duck
from tests.conftest import SF_SMALL

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(entry.queries()) and set(catalog.oracle_sql()) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["station_name", "avg_peak_departures"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    if not os.path.exists(f"{SF_SMALL}/events.parquet"):
        pytest.skip("test tables missing")
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = canonical(df.columns, df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    d_cols, d_rows = canonical([c[0] for c in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


@pytest.mark.parametrize("name", ["peak_departures", "update_merge_coalesce", "event_merge_overwrite",
                                  "xml_plan_rows", "json_station_flatten", "fuzzy_name_join", "graph_edges",
                                  "nearest_station_batch", "earliest_arrival"])
def test_no_python_evaluation_in_plans(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan


@pytest.mark.parametrize("name", ["time_slot_join", "cancellations_at_hour", "graph_edges", "parse_compact_ts",
                                  "parquet_partition_read", "earliest_arrival"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = entry.queries()[name](spark, SF_SMALL)
        got = canonical(df.columns, df.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    cur = con.execute(entry.oracle_sql()[name])
    assert got == canonical([c[0] for c in cur.description], cur.fetchall())
