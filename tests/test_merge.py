"""Merge semantics (warehouse coalesce merge vs Spark-path overwrite merge)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from railyard.operators import merge as M
from railyard.operators.analysis import latest_arrival_delay

T = dt.datetime


def plan(spark, rows):
    return spark.createDataFrame(rows, "stop_id string, planned_time timestamp_ntz")


def updates(spark, rows):
    # (stop_id, ct, cp, cs, clt, seq)
    return spark.createDataFrame(rows, "stop_id string, ct timestamp_ntz, cp string, cs string, clt string, seq int")


def test_coalesce_merge_keeps_last_non_null_time(spark):
    p = plan(spark, [("s1", T(2025, 9, 3, 10, 0))])
    u = updates(spark, [("s1", T(2025, 9, 3, 10, 5), None, None, None, 1), ("s1", None, "4", None, None, 2),
                        ("s1", T(2025, 9, 3, 10, 3), None, None, None, 3)])
    r = M.update_merge_coalesce(p, u, ["stop_id"], ["seq"]).first()
    assert (r.actual_time, r.delay_minutes, r.actual_platform, r.is_canceled) == (T(2025, 9, 3, 10, 3), 3, "4", False)


def test_overwrite_merge_takes_last_update_even_null(spark):
    p = plan(spark, [("s1", T(2025, 9, 3, 10, 0))])
    u = spark.createDataFrame([("s1", T(2025, 9, 3, 10, 5), True, 1), ("s1", None, False, 2)],
                              "stop_id string, actual_time timestamp_ntz, is_canceled boolean, seq int")
    ev = M.tag_events(p.withColumn("seq", F.lit(0)), u, ["stop_id"], ["seq"])
    r = M.event_merge_overwrite(ev, ["stop_id"], ["seq"]).first()
    assert (r.actual_time, r.delay_minutes, r.is_canceled) == (None, 0.0, False)


def test_cancellation_is_sticky_only_in_coalesce_merge(spark):
    p = plan(spark, [("s1", T(2025, 9, 3, 10, 0))])
    u = updates(spark, [("s1", None, None, "c", "2509031000", 1), ("s1", None, "1", None, None, 2)])
    assert M.update_merge_coalesce(p, u, ["stop_id"], ["seq"]).first().is_canceled is True
    uo = spark.createDataFrame([("s1", None, True, 1), ("s1", None, False, 2)],
                               "stop_id string, actual_time timestamp_ntz, is_canceled boolean, seq int")
    ev = M.tag_events(p.withColumn("seq", F.lit(0)), uo, ["stop_id"], ["seq"])
    assert M.event_merge_overwrite(ev, ["stop_id"], ["seq"]).first().is_canceled is False


def test_irrelevant_update_and_update_without_plan(spark):
    p = plan(spark, [("s1", T(2025, 9, 3, 10, 0))])
    u = updates(spark, [("s1", None, None, None, "x", 1), ("s9", T(2025, 9, 3, 11, 0), None, None, None, 1)])
    rows = M.update_merge_coalesce(p, u, ["stop_id"], ["seq"]).collect()
    assert [(r.stop_id, r.actual_time, r.delay_minutes) for r in rows] == [("s1", None, None)]
    uo = spark.createDataFrame([("s9", T(2025, 9, 3, 11, 0), False, 1)],
                               "stop_id string, actual_time timestamp_ntz, is_canceled boolean, seq int")
    ev = M.tag_events(p.withColumn("seq", F.lit(0)), uo, ["stop_id"], ["seq"])
    got = {r.stop_id: r for r in M.event_merge_overwrite(ev, ["stop_id"], ["seq"]).collect()}
    assert got["s9"].planned_time is None and got["s9"].event_date == dt.date(2025, 9, 3)


def test_planned_null_with_actual_gives_zero_delay(spark):
    p = plan(spark, [("s1", None)])
    u = updates(spark, [("s1", T(2025, 9, 3, 10, 5), None, None, None, 1)])
    assert M.update_merge_coalesce(p, u, ["stop_id"], ["seq"]).first().delay_minutes == 0


def test_merge_is_invariant_under_input_order(spark):
    rng = random.Random(7)
    rows = [(f"s{rng.randrange(20)}", T(2025, 9, 3, rng.randrange(24), rng.randrange(60)) if rng.random() < .7 else None,
             str(rng.randrange(9)) if rng.random() < .5 else None, "c" if rng.random() < .2 else None,
             "x" if rng.random() < .5 else None, i) for i in range(300)]
    p = plan(spark, [(f"s{i}", T(2025, 9, 3, 9, 0)) for i in range(20)])
    base = sorted(M.update_merge_coalesce(p, updates(spark, rows), ["stop_id"], ["seq"]).collect())
    rng.shuffle(rows)
    again = sorted(M.update_merge_coalesce(p, updates(spark, rows).repartition(7), ["stop_id"], ["seq"]).collect())
    assert base == again


def test_latest_snapshot_with_null_delay_is_excluded(spark):
    fact = spark.createDataFrame([(1, "a", True, 7, 1), (1, "a", True, None, 2), (1, "b", True, 4, 1)],
                                 "station_id long, stop_id string, is_arrival boolean, delay_minutes int, time_id int")
    st = spark.createDataFrame([(1, "X")], "station_id long, station_name string")
    assert latest_arrival_delay(fact, st, "X").first().avg_delay_minutes == 4.0


def test_fact_insert_ignores_existing_keys(spark):
    old = spark.createDataFrame([("a", True, 1)], "stop_id string, is_arrival boolean, seq int")
    new = spark.createDataFrame([("a", True, 0), ("b", True, 5), ("b", True, 3)], "stop_id string, is_arrival boolean, seq int")
    got = sorted(M.fact_insert_new(old, new, ["stop_id", "is_arrival"], ["seq"]).collect())
    assert [(r.stop_id, r.seq) for r in got] == [("a", 1), ("b", 3)]
