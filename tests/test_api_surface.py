"""Library entry points that the registered queries do not reach."""

import datetime as dt
import json

from railyard.operators.dims import train_dimension, train_rejects
from railyard.sources.json import flatten_stations, read_station_lines
from railyard.sources.sql import run_sql_file
from railyard.sources.timedim import slot_misses, time_dimension_between


def test_sql_file_station_json_lines_slot_misses_and_train_rejects(spark, tmp_dir):
    with open(f"{tmp_dir}/q.sql", "w") as fh:
        fh.write("-- station lookup\nSELECT station_id FROM dim_station WHERE station_name = :station_name;\n")
    st = spark.createDataFrame([(1, "A"), (2, "B")], "station_id long, station_name string")
    assert [r.station_id for r in run_sql_file(spark, f"{tmp_dir}/q.sql", {"station_name": "B"},
                                               {"dim_station": st}).collect()] == [2]

    with open(f"{tmp_dir}/st.jsonl", "w") as fh:
        fh.write(json.dumps({"name": "A", "evaNumbers": [{"number": 4, "isMain": True}]}) + "\n")
        fh.write(json.dumps({"name": "B", "evaNumbers": [{"number": 5, "isMain": False}]}) + "\n")
    assert [r.station_name for r in flatten_stations(read_station_lines(spark, f"{tmp_dir}/st.jsonl")).collect()] == ["A"]

    dim = time_dimension_between(spark, "2025-09-02 00:00:00", "2025-09-02 01:00:00")
    fact = spark.createDataFrame([(1, dt.datetime(2025, 9, 2, 0, 30)), (2, dt.datetime(2025, 9, 3, 0, 0))],
                                 "id int, slot_ts timestamp_ntz")
    assert [r.id for r in slot_misses(fact, dim).collect()] == [2]

    stops = spark.createDataFrame([("RE", "5", "o1", 2), ("RE", "5", "o0", 1), (None, "7", "o", 3), ("S", "x", "o", 4)],
                                  "category string, number string, owner string, seen_order int")
    assert [(r.train_id, r.owner_id) for r in train_dimension(stops).collect()] == [("RE-5", "o0")]
    assert train_rejects(stops).count() == 2
