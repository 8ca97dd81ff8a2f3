"""Hand fixtures for the document sources (FIXTURES §4)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from railyard.functions.names import overrides_frame
from railyard.sources import json as J
from railyard.sources import xml as X

PLAN = "/snap/2509031200/a_timetable.xml"
CHANGE = "/snap/2509031215/a_change.xml"


def docs(spark, *items):
    rows = [(path, text) for path, text in items]
    return spark.createDataFrame(rows, "file_path string, value string").withColumn(
        "snapshot_ts", F.lit(None).cast("timestamp_ntz"))


def test_stop_with_arrival_and_departure_gives_two_rows(spark):
    d = docs(spark, (PLAN, '<timetable station="Berlin Foo"><s id="1"><tl c="RE" n="5" o="800"/>'
                           '<ar pt="2509031201" pp="2"/><dp pt="2509031203" pp="2"/></s></timetable>'))
    rows = X.warehouse_plan_rows(d).orderBy("is_arrival").collect()
    assert [(r.is_arrival, r.planned_time, r.train_id, r.planned_platform) for r in rows] == [
        (False, dt.datetime(2025, 9, 3, 12, 3), "RE-5", "2"), (True, dt.datetime(2025, 9, 3, 12, 1), "RE-5", "2")]


def test_one_stop_no_stop_and_any_root_tag(spark):
    one = '<timetable station="A"><s id="1"><tl c="RE" n="5"/><ar pt="2509031201"/></s></timetable>'
    other_root = one.replace("timetable", "board")
    none = '<timetable station="A"></timetable>'
    assert X.warehouse_plan_rows(docs(spark, (PLAN, one))).count() == 1
    assert X.warehouse_plan_rows(docs(spark, (PLAN, none))).count() == 0
    assert X.warehouse_plan_rows(docs(spark, (PLAN, other_root))).count() == 1


def test_malformed_and_empty_documents_are_rejected(spark):
    good = '<timetable station="A"><s id="1"><tl c="RE" n="5"/><ar pt="2509031201"/></s></timetable>'
    d = docs(spark, (PLAN, good), (PLAN, good[:40]), (PLAN, ""))
    assert X.warehouse_plan_rows(d).count() == 1
    rep = X.malformed_report(d).first()
    assert (rep.n_documents, rep.n_rejected, rep.n_stops) == (3, 2, 1)


def test_stop_without_train_line(spark):
    text = '<timetable station="A"><s id="9"><ar pt="2509031201" ct="2509031206"/></s></timetable>'
    assert X.warehouse_plan_rows(docs(spark, (PLAN, text))).count() == 0
    assert X.warehouse_change_rows(docs(spark, (CHANGE, text))).count() == 1
    spark_rows = X.movement_rows(docs(spark, (PLAN, text)), overrides_frame(spark)).collect()
    assert len(spark_rows) == 1 and spark_rows[0].train_id is None


def test_bus_dropped_and_unknown_category_passes(spark):
    text = ('<timetable station="A"><s id="1"><tl c="Bus" n="5"/><ar pt="2509031201"/></s>'
            '<s id="2"><tl n="7"/><ar pt="2509031201"/></s></timetable>')
    wh = X.warehouse_plan_rows(docs(spark, (PLAN, text))).collect()
    assert [r.stop_id for r in wh] == ["2"]
    sp = X.movement_rows(docs(spark, (PLAN, text)), overrides_frame(spark)).collect()
    assert [(r.stop_id, r.train_id) for r in sp] == [("2", "Unknown-7")]


def test_bad_time_is_null_and_cancellation_needs_clt(spark):
    text = ('<timetable station="A"><s id="1"><ar ct="bad" cs="c" clt="2509031200"/></s>'
            '<s id="2"><ar cs="c"/></s></timetable>')
    rows = {r.stop_id: r for r in X.warehouse_change_rows(docs(spark, (CHANGE, text))).collect()}
    assert rows["1"].ct is None and rows["1"].cancelled is True
    assert rows["2"].cancelled is False


def test_change_without_time_platform_or_status_is_irrelevant(spark):
    text = '<timetable station="A"><s id="1"><ar clt="2509031200"/></s></timetable>'
    assert X.warehouse_change_rows(docs(spark, (CHANGE, text))).count() == 0
    assert X.movement_rows(docs(spark, (CHANGE, text)), overrides_frame(spark)).count() == 1


def test_spark_path_normalises_station_names(spark):
    text = '<timetable station="{}"><s id="1"><tl c="S" n="1"/><ar pt="2509031201"/></s></timetable>'
    d = docs(spark, (PLAN, text.format("Berlin Hbf")), (PLAN, text.format("Berlin Hauptbahnhof")),
             (PLAN, text.format("Ostkreuz")))
    got = sorted(r.station_name for r in X.movement_rows(d, overrides_frame(spark)).collect())
    assert got == ["Berlin Hauptbahnhof", "Hauptbahnhof", "Ostkreuz"]


def test_snapshot_folder_scan(spark, tmp_dir):
    good = '<timetable station="A"><s id="1"><tl c="RE" n="5"/><ar pt="2509031201"/></s></timetable>'
    for folder in ("2509031200", "2509031215", "notatime"):
        os.makedirs(f"{tmp_dir}/{folder}")
        with open(f"{tmp_dir}/{folder}/x_timetable.xml", "w") as fh:
            fh.write(good)
    files = X.scan_snapshot_files(spark, tmp_dir)
    snaps = sorted(r.snapshot_ts for r in files.collect())
    assert snaps == [dt.datetime(2025, 9, 3, 12, 0), dt.datetime(2025, 9, 3, 12, 15)]
    assert X.warehouse_plan_rows(files).count() == 2
    changes = X.scan_snapshot_files(spark, tmp_dir, suffix="_timetable.xml", validate_folder=False)
    assert changes.count() == 3


STATION_DOC = """{"result": [
  {"name": "A", "hasWiFi": "True", "evaNumbers": [{"number": 5, "isMain": false},
     {"number": 7, "isMain": true, "geographicCoordinates": {"coordinates": [13.4, 52.5]}}],
   "mailingAddress": {"zipcode": "10115"}, "category": 2},
  {"name": "B", "evaNumbers": [{"number": 8, "isMain": false}]},
  {"name": "C", "hasWiFi": true, "evaNumbers": [{"number": 9, "isMain": true,
     "geographicCoordinates": {"coordinates": [13.1]}}]},
  {"name": "D", "evaNumbers": [{"number": 0, "isMain": true}]},
  {"name": "E", "hasWiFi": null, "evaNumbers": [{"isMain": true}]}
]}"""


def test_station_json_flatten(spark, tmp_dir):
    path = f"{tmp_dir}/stations.json"
    with open(path, "w") as fh:
        fh.write(STATION_DOC)
    rows = {r.station_name: r for r in J.flatten_stations(J.read_station_documents(spark, path)).collect()}
    assert sorted(rows) == ["A", "C"]  # B: no main entry; D: number 0; E: no number
    a, c = rows["A"], rows["C"]
    assert (a.station_id, a.latitude, a.longitude, a.has_wifi, a.zipcode, a.category) == (7, 52.5, 13.4, True, "10115", 2)
    assert (c.latitude, c.longitude, c.has_wifi) == (None, 13.1, True)
    text = spark.createDataFrame([(STATION_DOC,), ("{broken",)], "value string")
    assert J.flatten_stations(J.parse_station_documents(text)).count() == 2


def test_many_small_files_are_read_by_few_tasks(spark, tmp_dir):
    """10,000 files; and a later scan that looks at new folders only."""
    from railyard.sources.xml import scan_snapshot_files, snapshot_folders
    names = [f"25090{1 + k // 24}{k % 24:02d}00" for k in range(100)]
    for k, name in enumerate([*names, "notes"]):
        os.makedirs(f"{tmp_dir}/in/{name}")
        for n in range(100):
            with open(f"{tmp_dir}/in/{name}/{n}_timetable.xml", "w") as out:
                out.write(f'<timetable station="S{k}"/>')
    every = scan_snapshot_files(spark, f"{tmp_dir}/in")
    assert every.count() == 10_000 and every.rdd.getNumPartitions() <= 32
    assert scan_snapshot_files(spark, f"{tmp_dir}/in", validate_folder=False).count() == 10_100
    assert snapshot_folders(spark, f"{tmp_dir}/in", since=names[97]) == sorted(names)[97:]
    late = scan_snapshot_files(spark, f"{tmp_dir}/in", since=names[97])
    assert late.count() == 300 and {f.rsplit("/", 2)[1] for f in late.inputFiles()} == set(names[97:])
    assert scan_snapshot_files(spark, f"{tmp_dir}/in", since="2601010000").collect() == []
