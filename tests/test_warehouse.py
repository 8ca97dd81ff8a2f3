"""End-to-end warehouse load from hand-written snapshot documents."""

import datetime as dt

from pyspark.sql import functions as F

from railyard.functions.names import overrides_frame
from railyard.operators.checks import unique_violations
from railyard.operators.warehouse import apply_changes, load_fact
from railyard.sources.parquet import overwrite_dates, read_movement_events, write_movement_events
from railyard.sources.timedim import time_dimension_between

T = dt.datetime


def _docs(spark, items):
    return spark.createDataFrame(
        [(p, T(2025, 9, 3, 12, m), v) for p, m, v in items], "file_path string, snapshot_ts timestamp_ntz, value string")


def test_load_and_update(spark):
    st = spark.createDataFrame([(1, "Alexanderplatz"), (2, "Berlin Hauptbahnhof")], "station_id long, station_name string")
    dim_time = time_dimension_between(spark)
    stop = '<s id="{i}"><tl c="RE" n="{n}" o="{o}"/><ar pt="2509031230" pp="1"/></s>'
    plan = _docs(spark, [
        ("/t/2509031200/a_timetable.xml", 0, '<timetable station="Berlin Alexanderplatz">' + stop.format(i=1, n=5, o="x")
         + '</timetable>'),
        ("/t/2509031215/a_timetable.xml", 15, '<timetable station="Berlin Alexanderplatz">' + stop.format(i=1, n=5, o="y")
         + '</timetable>'),
        ("/t/2509031215/b_timetable.xml", 15, '<timetable station="Berlin Hbf">' + stop.format(i=2, n=6, o="z")
         + stop.format(i=2, n=6, o="z") + '</timetable>'),
        ("/t/2509031215/c_timetable.xml", 15, '<timetable station="Nowhere">' + stop.format(i=3, n=7, o="z")
         + '</timetable>')])
    fact, trains, rejects = load_fact(plan, st, dim_time, overrides_frame(spark))
    assert fact.count() == 3  # stop 1 in two snapshots, stop 2 once (duplicate in one file dropped)
    assert unique_violations(fact, ["station_id", "time_id", "stop_id", "is_arrival"]).count() == 0
    assert fact.select("movement_pk").distinct().count() == 3
    assert {(r.train_id, r.owner_id) for r in trains.collect()} == {("RE-5", "x"), ("RE-6", "z")}
    assert [r.reason for r in rejects.collect()] == ["no match"]
    changes = _docs(spark, [("/c/2509031220/a_change.xml", 20,
                             '<timetable station="Berlin Alexanderplatz"><s id="1"><ar ct="2509031236"/></s></timetable>')])
    lost = _docs(spark, [("/c/2509031220/b_change.xml", 20, '<timetable station="Nowhere"><s id="3"><ar ct="2509031240"/></s></timetable>')])
    merged, unknown, counts = apply_changes(fact, changes.unionByName(lost), st, overrides_frame(spark))
    assert [(r.station_name, r.stop_id, r.reason) for r in unknown.collect()] == [("Nowhere", "3", "no match")]
    assert counts == {"n_rows": 3, "n_updated": 2, "n_updates": 1, "n_without_row": 0, "n_unresolved": 1}
    got = sorted((r.stop_id, r.time_id, r.delay_minutes) for r in merged.collect())
    t0 = dim_time.filter(F.col("slot_ts") == F.lit("2025-09-03 12:00:00").cast("timestamp_ntz")).first().time_id
    assert got == [("1", t0, 6), ("1", t0 + 1, 6), ("2", t0 + 1, None)]


def test_dynamic_date_overwrite(spark, tmp_dir):
    rows = [("A", "1", None, True, T(2025, 9, 3, 10), None, 0.0, False, dt.date(2025, 9, 3)),
            ("A", "2", None, True, T(2025, 9, 4, 10), None, 0.0, False, dt.date(2025, 9, 4))]
    schema = ("station_name string, stop_id string, train_id string, is_arrival boolean, planned_time timestamp_ntz, "
              "actual_time timestamp_ntz, delay_minutes double, is_canceled boolean, event_date date")
    path = write_movement_events(spark.createDataFrame(rows, schema), f"{tmp_dir}/mv")
    newer = [("A", "3", None, True, T(2025, 9, 4, 11), None, 1.0, False, dt.date(2025, 9, 4))]
    overwrite_dates(spark.createDataFrame(newer, schema), path)
    got = sorted((r.stop_id, r.event_date) for r in read_movement_events(spark, path).collect())
    assert got == [("1", dt.date(2025, 9, 3)), ("3", dt.date(2025, 9, 4))]
    assert read_movement_events(spark, path, date_from="2025-09-04").count() == 1
