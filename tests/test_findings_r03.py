"""What the third review found: memory of one task in route and nearest-station searches, bytes of a fact's update, the encoder's batches."""

import datetime as dt
import random
from collections import defaultdict

from pyspark.sql import functions as F

from railyard.operators import graph as G
from railyard.operators import nearest

T = dt.datetime
EDGES = "u int, v int, dep timestamp_ntz, arr timestamp_ntz"


def random_edges(n=600):
    r = random.Random(6)
    minute = lambda k: T(2024, 1, 1) + dt.timedelta(minutes=k)
    rows = []
    for _ in range(n):
        dep = r.randrange(3 * 1440)
        u, v = r.sample(range(4), 2)
        rows.append((u, v, minute(dep), minute(dep + r.choice([0, 5, 30, 200, 1500]))))
    return rows + rows[:50]


def test_a_search_reads_only_edges_that_no_later_one_beats(spark):
    rows = random_edges()
    front = G.quickest_edges(spark.createDataFrame(rows, EDGES)).collect()
    by = defaultdict(set)
    for u, v, dep, arr in rows:
        by[u, v, dep.date()].add((dep, arr))
    want = {(u, v, dep, arr) for (u, v, _), es in by.items() for dep, arr in es
            if not any((d, a) != (dep, arr) and d >= dep and a <= arr for d, a in es)}
    assert {(r.u, r.v, r.dep, r.arr) for r in front} == want and len(front) == len(want) < len(set(rows))
    for r in front:
        before = [x[2] for x in want if x[:2] == (r.u, r.v) and x[2].date() == r.dep.date() and x[2] < r.dep]
        assert r.prev == (max(before) if before else None)


def test_labels_over_many_edges_of_a_pair_equal_a_plain_search(spark):
    rows = random_edges()
    start = [(o, T(2024, 1, 1, h)) for o in range(4) for h in (0, 7, 20)]
    sources = spark.createDataFrame(start, "origin_id int, depart_ts timestamp_ntz")
    got = defaultdict(dict)
    for r in G.source_labels(sources, spark.createDataFrame(rows, EDGES), 2, relaxations=2000).collect():
        got[r.origin_id, r.depart_ts][r.station_id] = r.arrival
    for o, t in start:
        best, changed = {o: t}, True
        while changed:
            changed = False
            for u, v, dep, arr in rows:
                if u in best and dep >= best[u] + dt.timedelta(minutes=2 if u != o else 0) and (v not in best or arr < best[v]):
                    best[v], changed = arr, True
        assert got[o, t] == best


def test_a_round_of_labels_sorts_no_joined_rows(spark):
    usable = G.quickest_edges(spark.createDataFrame(random_edges(), EDGES))
    state = spark.createDataFrame([(0, T(2024, 1, 1), 0, None, T(2024, 1, 1), True)],
                                  "origin_id int, depart_ts timestamp_ntz, station_id int, bound timestamp_ntz, arrival timestamp_ntz, fresh boolean")
    plan = G._relaxed(state, usable, "true", 2)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_a_point_meets_the_places_of_a_leaf_as_one_row(spark):
    stations = spark.range(400).select(F.col("id").alias("station_id"), F.format_string("n%d", F.col("id")).alias("station_name"),
                                       (F.col("id") % 20).cast("double").alias("latitude"), F.floor(F.col("id") / 20).cast("double").alias("longitude"))
    points = spark.range(500).select(F.col("id").alias("point_id"), (F.rand(1) * 20).alias("latitude"), (F.rand(2) * 20).alias("longitude"))
    found = nearest.nearest_station_per_point(points, stations)
    seen = found._jdf.queryExecution().optimizedPlan().toString()
    best = seen[:seen.index("Join")]
    assert "array_min" in best  # one row for each leaf goes into the last sort
    rows = points.join(found, "point_id").join(stations.withColumnRenamed("latitude", "a").withColumnRenamed("longitude", "b"), "station_id").collect()
    assert len(rows) == 500
    for r in rows:
        d = [((r.latitude - i % 20) ** 2 + (r.longitude - i // 20) ** 2, i) for i in range(400)]
        assert min(d)[1] == r.station_id


def test_an_encoder_splits_a_batch_a_slice_at_a_time(monkeypatch):
    from railyard.llm import pieces, sentence_pieces
    loaded = pieces.Pieces.load()
    texts = ["station name " * k for k in range(40)] + [None, "", "x" * 500]
    whole = [x.tolist() for x in sentence_pieces.Encoder(loaded).encode(texts)]
    monkeypatch.setattr(sentence_pieces, "SLICE_CHARS", 300)
    sizes, plain = [], sentence_pieces.Encoder.encode_slice
    monkeypatch.setattr(sentence_pieces.Encoder, "encode_slice", lambda self, ts: sizes.append([len(t or "") for t in ts]) or plain(self, ts))
    assert [x.tolist() for x in sentence_pieces.Encoder(loaded).encode(texts)] == whole
    assert sum(map(len, sizes)) == len(texts) and all(len(s) == 1 or sum(s) <= 300 for s in sizes)


FACT = "station_id long, time_id int, train_id string, stop_id string, is_arrival boolean, planned_time timestamp_ntz"
CHANGES = "station_id long, stop_id string, is_arrival boolean, ct timestamp_ntz, cp string, cs string, clt timestamp_ntz, n int"


def test_a_load_writes_only_the_store_and_looks_up_what_a_slice_leaves(spark, tmp_dir, monkeypatch):
    from railyard.sources import star
    aside = []
    for module in ("write_table", "write_table_metrics"):
        monkeypatch.setattr(star, module, lambda df, name, **k: aside.append(name) or (df, {}))
    fact = spark.createDataFrame([(s, 1, "T", f"x{d}", True, T(2025, m, d, 12)) for m in (1, 2, 3) for d in range(1, 21) for s in (m,)], FACT)
    star.write_star_table(fact, tmp_dir, star.FACT, grain="MONTH")
    gathered, plain = [], star.Versions.write
    monkeypatch.setattr(star.Versions, "write", lambda self, *a, gather=True: gathered.append(gather) or plain(self, *a, gather=gather))
    many = spark.createDataFrame([(1, f"x{d}", True, None, str(d), None, None, 1) for d in range(1, 21)], CHANGES)
    one = spark.createDataFrame([(3, "x7", True, T(2025, 3, 7, 12, 4), None, None, None, 1)], CHANGES)
    for slices in (1, 2, 64):
        monkeypatch.setattr(star, "SLICES", slices)
        assert star.update_fact(spark, tmp_dir, many.unionByName(one), ["n"]) == ["2025-01-01", "2025-03-01"]
        assert star.update_fact(spark, tmp_dir, one, ["n"]) == ["2025-03-01"]
    assert aside == [] and gathered == [False] * 6
    rows = star.read_star_table(spark, tmp_dir, star.FACT).collect()
    assert len(rows) == 60 and sum(r.actual_platform is not None for r in rows) == 20
    assert [(r.station_id, r.stop_id, r.delay_minutes) for r in rows if r.actual_time] == [(3, "x7", 4)]
    monkeypatch.setattr(star, "MOST_FILES", 0)
    star.update_fact(spark, tmp_dir, one, ["n"])
    assert gathered[-1] is True


def test_keys_whose_hashes_meet_are_counted_themselves(spark, monkeypatch):
    from railyard.sources import star
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "x int, y string")
    assert star.repeated_keys(rows, ("x", "y")) == 0 and star.repeated_keys(rows, ("x",)) == 1
    monkeypatch.setattr(star.F, "xxhash64", lambda *c: F.lit(7))
    assert star.repeated_keys(rows, ("x", "y")) == 0 and star.repeated_keys(rows, ("y",)) == 1
