"""Versioned tables behind a manifest: updates of the fact by date, replacement of a dimension, failures in between."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from railyard.sources import star
from railyard.sources.versions import Versions

T = dt.datetime
FACT = "station_id long, time_id int, train_id string, stop_id string, is_arrival boolean, planned_time timestamp_ntz, planned_platform string"
UPDATES = "station_id long, stop_id string, is_arrival boolean, ct timestamp_ntz, cp string, cs string, clt timestamp_ntz, n int"


def fact(spark, days=5):
    rows = [(s, t, "S-1", f"x{d}", True, T(2025, 9, d, 12, s), "1") for d in range(1, days + 1) for s in (1, 2) for t in (10, 11)]
    return spark.createDataFrame([*rows, (1, 10, "S-1", "undated", False, None, None)], FACT)


@pytest.fixture()
def root(spark, tmp_dir):
    star.write_star_table(fact(spark), tmp_dir, star.FACT)
    star.write_star_table(spark.createDataFrame([(1, "A"), (2, "B")], "station_id long, station_name string"), tmp_dir, "dim_station")
    return tmp_dir


def parts(spark, root):
    return Versions(spark, root).parts(star.FACT)


def files(spark, root, part):
    folder = Versions(spark, root)._path(f"{root}/{parts(spark, root)[part]}")
    return sorted((f.getPath().getName(), f.getModificationTime()) for f in Versions(spark, root).files.listStatus(folder))


def test_update_writes_only_the_dates_it_touches(spark, root):
    before, kept = parts(spark, root), files(spark, root, "2025-09-01")
    assert sorted(before) == ["2025-09-01", "2025-09-02", "2025-09-03", "2025-09-04", "2025-09-05", "all"]
    updates = spark.createDataFrame([(2, "x3", True, T(2025, 9, 3, 12, 9), "7", None, None, 1), (2, "x3", True, None, "8", None, None, 2),
                                     (1, "undated", False, None, None, "c", T(2025, 9, 3), 1), (9, "x1", True, None, "5", None, None, 1)], UPDATES)
    assert star.update_fact(spark, root, updates, ["n"]) == ["2025-09-03", "all"]
    after = parts(spark, root)
    assert {p for p in before if before[p] != after[p]} == {"2025-09-03", "all"} and files(spark, root, "2025-09-01") == kept
    rows = star.read_star_table(spark, root, star.FACT).collect()
    assert len(rows) == 21
    hit = [r for r in rows if r.actual_platform]
    assert {(r.station_id, r.time_id, r.actual_platform, r.delay_minutes) for r in hit} == {(2, 10, "8", 7), (2, 11, "8", 7)}
    assert [r.stop_id for r in rows if r.is_canceled] == ["undated"]
    # A second load changes only what it carries; one that meets no row changes nothing.
    star.update_fact(spark, root, spark.createDataFrame([(2, "x3", True, None, "9", None, None, 3)], UPDATES), ["n"])
    again = [r for r in star.read_star_table(spark, root, star.FACT, ["2025-09-03"]).collect() if r.station_id == 2]
    assert {(r.actual_platform, r.actual_time) for r in again} == {("9", T(2025, 9, 3, 12, 9))}
    number = Versions(spark, root).current()["number"]
    assert star.update_fact(spark, root, spark.createDataFrame([(77, "x3", True, None, "9", None, None, 3)], UPDATES), ["n"]) == []
    assert Versions(spark, root).current()["number"] == number


def test_replaced_dimension_drops_rows_of_its_dates_only(spark, root):
    before = parts(spark, root)
    only = spark.createDataFrame([(1, 10, "S-1", "late", True, T(2025, 9, 9, 9), None), (3, 10, "S-1", "late", True, T(2025, 9, 9, 9), None),
                                  (3, 10, "S-1", "gone", True, T(2025, 9, 8, 9), None)], FACT)
    star.write_star_table(fact(spark).unionByName(only), root, star.FACT)
    before = parts(spark, root)
    lost = star.replace_dimension(spark.createDataFrame([(1, "A"), (2, "C")], "station_id long, station_name string"), root, "dim_station")
    after = parts(spark, root)
    assert sorted(r.stop_id for r in lost.collect()) == ["gone", "late"]
    assert set(before) - set(after) == {"2025-09-08"} and {p for p in after if before[p] != after[p]} == {"2025-09-09"}
    assert star.read_star_table(spark, root, star.FACT).count() == 22
    assert {r.station_name for r in star.read_star_table(spark, root, "dim_station").collect()} == {"A", "C"}


@pytest.mark.parametrize("writes", [0, 1, 2])
def test_a_failure_leaves_the_old_pair(spark, root, monkeypatch, writes):
    plain, done = Versions.write, []

    def failing(self, *args, **kwargs):
        if len(done) == writes:
            raise OSError("disk")
        done.append(1)
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(Versions, "write", failing)
    if writes == 2:
        monkeypatch.setattr(Versions, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("no rename")))
    with pytest.raises(OSError):
        star.replace_dimension(spark.createDataFrame([(1, "only")], "station_id long, station_name string"), root, "dim_station")
    monkeypatch.undo()
    assert {r.station_name for r in star.read_star_table(spark, root, "dim_station").collect()} == {"A", "B"}
    assert star.read_star_table(spark, root, star.FACT).count() == 21
    dropped = Versions(spark, root).drop_old()
    assert (dropped > 0) == (writes > 0) and star.read_star_table(spark, root, star.FACT).count() == 21


def test_of_two_writers_one_fails(spark, root):
    store = Versions(spark, root)
    on = store.current()["number"]
    written = store.write("dim_station", spark.createDataFrame([(3, "C")], "station_id long, station_name string"))
    store.commit({}, on=on)
    with pytest.raises(RuntimeError, match="meanwhile"):
        store.commit({"dim_station": written}, replace=["dim_station"], on=on)
    assert {r.station_name for r in star.read_star_table(spark, root, "dim_station").collect()} == {"A", "B"}


def test_longer_grain(spark, tmp_dir):
    star.write_star_table(fact(spark, 9), tmp_dir, star.FACT, grain="MONTH")
    assert sorted(parts(spark, tmp_dir)) == ["2025-09-01", "all"]
    star.update_fact(spark, tmp_dir, spark.createDataFrame([(2, "x9", True, None, "9", None, None, 3)], UPDATES), ["n"])
    assert star.read_star_table(spark, tmp_dir, star.FACT).filter(F.col("actual_platform") == "9").count() == 2
