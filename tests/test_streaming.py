"""Incremental change ingest: exactly-once log, a fold merged batch by batch, late folders."""

import datetime as dt
import os
import random

from railyard.operators.merge import update_merge_coalesce
from railyard.session import write_table
from railyard.sources.versions import Versions
from railyard.streaming import incremental as I

T = dt.datetime
PLAN = "station_name string, stop_id string, is_arrival boolean, planned_time timestamp_ntz"


def _write(root, folder, name, text):
    os.makedirs(f"{root}/{folder}", exist_ok=True)
    with open(f"{root}/{folder}/{name}_change.xml", "w") as fh:
        fh.write(text)


def test_incremental_ingest_and_merge(spark, tmp_dir):
    root, log, fold, ckpt = (f"{tmp_dir}/{x}" for x in ("changes", "log", "fold", "ckpt"))
    ingest = lambda: I.ingest_changes(spark, root, log, ckpt, fold).awaitTermination()
    _write(root, "2509031205", "a", '<timetable station="A"><s id="1"><ar ct="2509031205"/></s></timetable>')
    ingest()
    # The log of the first batch is not needed again.
    os.rename(f"{log}/batch_id=0", f"{tmp_dir}/aside")
    # A later folder and a late folder that sorts earlier than the first.
    _write(root, "2509031210", "a", '<timetable station="A"><s id="1"><ar ct="2509031207" cp="3"/></s></timetable>')
    _write(root, "2509031200", "a", '<timetable station="A"><s id="1"><ar ct="2509031201"/></s></timetable>')
    ingest()
    ingest()  # nothing new: no duplicates
    os.rename(f"{tmp_dir}/aside", f"{log}/batch_id=0")
    logged = I.read_change_log(spark, log)
    assert logged.count() == 3
    plan = spark.createDataFrame([("A", "1", True, T(2025, 9, 3, 12, 0)), ("B", "1", True, T(2025, 9, 3, 12, 0))], PLAN)
    rows = {r.station_name: r for r in I.merged_view(plan, fold, logged).collect()}
    assert (rows["A"].actual_time, rows["A"].delay_minutes, rows["A"].actual_platform) == (T(2025, 9, 3, 12, 7), 7, "3")
    assert rows["B"].actual_time is None and rows["B"].is_canceled is False


def test_batches_in_any_order_equal_one_load(spark, tmp_dir):
    r = random.Random(4)
    schema = "stop_id string, ct timestamp_ntz, cp string, cs string, clt timestamp_ntz, n int"
    rows = [(f"s{r.randrange(30)}", r.choice([None, T(2024, 1, 1, 10, r.randrange(60))]), r.choice([None, "", "1", "2"]),
             r.choice([None, None, "c"]), r.choice([None, T(2024, 1, 1)]), k) for k in range(300)]
    plan = spark.createDataFrame([(f"s{k}", T(2024, 1, 1, 9, k)) for k in range(32)], "stop_id string, planned_time timestamp_ntz")
    updates = write_table(spark.createDataFrame(rows, schema), "test-updates")
    r.shuffle(rows)
    for k in range(3):
        batch = spark.createDataFrame(rows[k * 100:(k + 1) * 100], schema)
        I.merge_into_fold(batch, tmp_dir, ["stop_id"], ["n"], batch=("test", k))
        if k == 1:
            assert I.merge_into_fold(batch, tmp_dir, ["stop_id"], ["n"], batch=("test", 1)) == []  # a replay changes nothing
    got = I.merged_view(plan, tmp_dir, updates, ["stop_id"], ["n"])
    want = update_merge_coalesce(plan, updates, ["stop_id"], ["n"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    fold = I.read_fold(spark, tmp_dir, I.fold_schema(updates, ["stop_id"], ["n"]))
    relevant = [x for x in rows if x[1] or x[2] or x[3]]
    assert sum(x.n_updates for x in fold.collect()) == len(relevant)


def test_a_batch_writes_only_its_buckets(spark, tmp_dir):
    schema = "stop_id string, ct timestamp_ntz, cp string, cs string, clt timestamp_ntz, n int"
    many = spark.createDataFrame([(f"s{k}", None, "1", None, None, 0) for k in range(500)], schema)
    I.merge_into_fold(many, tmp_dir, ["stop_id"], ["n"])
    before = Versions(spark, tmp_dir).parts(I.FOLD)
    touched = I.merge_into_fold(spark.createDataFrame([("s7", None, "2", None, None, 1)], schema), tmp_dir, ["stop_id"], ["n"])
    after = Versions(spark, tmp_dir).parts(I.FOLD)
    assert len(touched) == 1 and {b for b in before if before[b] != after[b]} == set(touched) and set(before) == set(after)
