"""Names, graph properties against plain-Python searches, time dimension, scalar functions."""

import datetime as dt
import heapq
import random
from collections import defaultdict, deque

from pyspark.sql import functions as F

from railyard.functions.names import normalize_names, overrides_frame
from railyard.functions.timefmt import parse_compact_ts
from railyard.operators import graph as G
from railyard.operators import resolve as R
from railyard.operators.nearest import nearest_station_per_point
from railyard.plans import roles
from railyard.sources.sql import run_sql
from railyard.sources.timedim import time_dimension_between
from tests.conftest import SF_SMALL

T = dt.datetime


def test_trigram_similarity_reference_examples(spark):
    pairs = spark.createDataFrame([("Attilastr.", "Attilastraße"), ("Hbf", "Berlin Hauptbahnhof")], "a string, b string")
    got = {r.a: round(r.similarity, 3) for r in R.pair_similarity(pairs, "a", "b").collect()}
    assert got == {"Attilastr.": 0.643, "Hbf": 0.043}


def test_resolution_cascade_and_reasons(spark):
    st = spark.createDataFrame([(1, "Alexanderplatz"), (2, "Attilastraße"), (3, "Twin"), (4, "Twin"),
                                (5, "Berlin Hauptbahnhof")], "station_id long, station_name string")
    raw = spark.createDataFrame([("Berlin Alexanderplatz",), ("Berlin Attilastr.",), ("Berlin Twin",),
                                 ("Berlin Hbf",), ("Berlin Yorckstr.(S2)",), ("Qqq",)], "raw_name string")
    got = {r.raw_name: (r.station_id, r.method, r.reason)
           for r in R.resolve_names(raw, st, overrides_frame(spark)).collect()}
    assert got == {
        "Berlin Alexanderplatz": (1, "exact", None),
        "Berlin Attilastr.": (2, "fuzzy", None),
        "Berlin Twin": (None, None, "ambiguous name"),
        "Berlin Hbf": (5, "override", None),
        "Berlin Yorckstr.(S2)": (None, None, "override target missing"),
        "Qqq": (None, None, "no match"),
    }


def test_fuzzy_join_equals_brute_force(spark):
    st = roles.name_stations(spark, SF_SMALL)
    probes = roles.raw_names(spark, SF_SMALL).select(F.col("raw_name").alias("q"))
    fast = {(r.q, r.station_id) for r in R.fuzzy_candidates(probes, "q", st).collect()}
    pairs = probes.crossJoin(st)  # brute force on a small fixture only
    brute = {(r.q, r.station_id) for r in R.pair_similarity(pairs.select("q", "station_name"), "q", "station_name")
             .join(st, "station_name").filter("n_shared * 5 > n_union * 2").collect()}
    assert fast == brute and fast


def test_normalisation_keeps_reference_quirk(spark):
    df = spark.createDataFrame([("Berlin Hauptbahnhof",), ("Berlin Hbf",), ("",)], "raw string")
    got = {r.raw: r.normalized for r in normalize_names(df, "raw", overrides_frame(spark)).collect()}
    assert got == {"Berlin Hauptbahnhof": "Hauptbahnhof", "Berlin Hbf": "Berlin Hauptbahnhof", "": None}


def test_compact_timestamp_parsing(spark):
    df = spark.createDataFrame([("2509031205",), ("",), (None,), ("bad",), ("2513031205",), ("6901010000",)], "s string")
    got = [r.t for r in df.select(parse_compact_ts("s").alias("t")).collect()]
    assert got == [T(2025, 9, 3, 12, 5), None, None, None, None, T(1969, 1, 1, 0, 0)]


def test_time_dimension_reference_bounds(spark):
    d = time_dimension_between(spark)
    assert d.count() == 4129
    per_day = d.groupBy("date").count().filter("count = 96").count()
    assert per_day == 43
    first = d.orderBy("time_id").first()
    assert (first.time_id, first.day_of_week, first.is_weekend) == (1, "Tuesday", False)
    assert d.filter("is_peak_hour").count() == 43 * 16


def test_param_sql_binds_named_markers(spark):
    st = spark.createDataFrame([(1, "A", 1.0, 2.0)], "station_id long, station_name string, latitude double, longitude double")
    text = "-- lookup\nSELECT station_id, latitude FROM dim_station WHERE station_name = :station_name;"
    assert run_sql(spark, text, {"station_name": "A"}, {"dim_station": st}).collect()[0].station_id == 1


def _python_graph(edges):
    adj, sched = defaultdict(set), defaultdict(list)
    for e in edges:
        adj[e.u].add(e.v)
        sched[e.u].append((e.dep, e.arr, e.v))
    return adj, sched


def test_bfs_equals_python_bfs(spark):
    edges = G.build_edges(roles.graph_movements(spark, SF_SMALL), *roles.ARRIVAL_WINDOW)
    st = roles.graph_stations(spark, SF_SMALL)
    adj, _ = _python_graph(edges.collect())
    name = {r.station_id: r.station_name for r in st.collect()}
    got = {(r.origin_id, r.station_id): (r.hops, r.path)
           for r in G.bfs_paths(G.adjacency(edges), st, st.select(F.col("station_id").alias("origin_id"))).collect()}
    for o in name:
        best = {o: [name[o]]}
        level = [o]
        while level:
            nxt = {}
            for u in level:
                for v in adj[u]:
                    if v not in best:
                        cand = best[u] + [name[v]]
                        if v not in nxt or cand < nxt[v]:
                            nxt[v] = cand
            best.update(nxt)
            level = sorted(nxt)
        for v, path in best.items():
            assert got[(o, v)] == (len(path) - 1, path)


def test_earliest_arrival_equals_dijkstra_and_itinerary_is_valid(spark):
    edges = G.build_edges(roles.graph_movements(spark, SF_SMALL), *roles.ARRIVAL_WINDOW)
    el = edges.collect()
    _, sched = _python_graph(el)
    origins = sorted(sched)[:4]
    start = T(2024, 1, 2, 0, 0)
    starts = spark.createDataFrame([(o, o, start) for o in origins], "request_id long, origin_id int, depart_ts timestamp_ntz")
    got = {(r.request_id, r.station_id): r.arrival for r in G.earliest_arrival_labels(starts, edges).collect()}
    for o in origins:
        best = {o: start}
        pq = [(start, o)]
        while pq:
            t, u = heapq.heappop(pq)
            if t > best[u]:
                continue
            need = t if u == o else t + dt.timedelta(minutes=2)
            for dep, arr, v in sched[u]:
                if dep >= need and (v not in best or arr < best[v]):
                    best[v] = arr
                    heapq.heappush(pq, (arr, v))
        assert {k[1]: v for k, v in got.items() if k[0] == o} == best


def test_transfer_buffer_blocks_one_minute_dwell(spark):
    mv = spark.createDataFrame([
        (1, 10, False, T(2024, 1, 1, 8, 0), 1), (1, 20, True, T(2024, 1, 1, 8, 10), 2),
        (2, 20, False, T(2024, 1, 1, 8, 11), 3), (2, 30, True, T(2024, 1, 1, 8, 20), 4),
        (3, 20, False, T(2024, 1, 1, 8, 12), 5), (3, 30, True, T(2024, 1, 1, 8, 40), 6)],
        "train_id long, station_id int, is_arrival boolean, planned_time timestamp_ntz, tie long")
    edges = G.build_edges(mv, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    st = spark.createDataFrame([(10, "A"), (20, "B"), (30, "C")], "station_id int, station_name string")
    req = spark.createDataFrame([(1, "A", "C", "2024-01-01 07:55")],
                                "request_id int, origin_name string, destination_name string, depart_text string")
    r = G.earliest_arrival(req, edges, st).first()
    assert r.arrival == T(2024, 1, 1, 8, 40)  # the 8:11 departure is within the 2-minute buffer
    it = G.itineraries(req, edges, st).first()
    assert it.itinerary == "A 08:00 [1] -> B 08:12 [3] -> C arr 08:40"


def test_edges_cross_bucket_boundaries(spark):
    mv = spark.createDataFrame([
        (1, 10, False, T(2024, 1, 1, 23, 50), 1), (1, 20, True, T(2024, 1, 2, 0, 10), 2),
        (1, 20, False, T(2024, 1, 2, 0, 15), 3), (1, 30, True, T(2024, 1, 5, 9, 0), 4)],
        "train_id long, station_id int, is_arrival boolean, planned_time timestamp_ntz, tie long")
    got = sorted((r.u, r.v) for r in G.build_edges(mv, "2024-01-01 00:00:00", "2024-02-01 00:00:00").collect())
    assert got == [(10, 20), (20, 30)]


def test_grid_nearest_equals_brute_force_with_ties(spark):
    rng = random.Random(3)
    stations = [(i, f"s{i}", float(rng.randrange(20)), float(rng.randrange(20))) for i in range(60)]
    stations.append((99, "dup", stations[0][2], stations[0][3]))  # exact tie with station 0
    pts = [(j, rng.uniform(-5, 25), rng.uniform(-5, 25)) for j in range(300)] + [(999, stations[0][2], stations[0][3])]
    sdf = spark.createDataFrame(stations, "station_id long, station_name string, latitude double, longitude double")
    pdf = spark.createDataFrame(pts, "point_id long, latitude double, longitude double")
    got = {r.point_id: r.station_id for r in nearest_station_per_point(pdf, sdf).collect()}
    for pid, la, lo in pts:
        best = min(stations, key=lambda s: ((s[2] - la) ** 2 + (s[3] - lo) ** 2, s[0]))
        assert got[pid] == best[0]


def test_edges_equal_sequential_pairing_with_a_dominant_train(spark):
    rng = random.Random(11)
    rows = []
    for i in range(1500):
        train = 1 if rng.random() < 0.6 else rng.randrange(2, 12)  # train 1 holds most rows
        t = T(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 6))
        rows.append((train, rng.randrange(15), rng.random() < 0.5, t, i))
    mv = spark.createDataFrame(rows, "train_id long, station_id int, is_arrival boolean, planned_time timestamp_ntz, tie long")
    got = sorted(tuple(r) for r in G.build_edges(mv, "2024-01-01 00:00:00", "2024-01-08 00:00:00").collect())
    want = []
    by_train = defaultdict(list)
    for r in rows:
        by_train[r[0]].append(r)
    for train, rs in by_train.items():
        rs.sort(key=lambda r: (r[3], r[4]))
        for a, b in zip(rs, rs[1:]):
            if not a[2] and b[2] and a[1] != b[1]:
                want.append((train, a[1], b[1], a[3], b[3]))
    assert got == sorted(want)
