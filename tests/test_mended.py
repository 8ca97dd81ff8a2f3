"""Cases of earlier faults: repeated loads, unknown trains, deep searches, far points, scratch folders."""

import datetime as dt
import heapq
import random

import pytest
from pyspark.sql import functions as F

from railyard import session
from railyard.operators import checks as C
from railyard.operators import graph as G
from railyard.operators.dims import has_train, train_dimension, train_rejects, with_surrogate_key
from railyard.operators.merge import counted_load, update_merge_coalesce
from railyard.operators.nearest import LEAF_PLACES, cell_tree, nearest_station_per_point
from railyard.operators.resolve import fuzzy_candidates, pair_similarity
from railyard.sources.sql import run_sql

T = dt.datetime
UPDATES = "stop_id string, ct timestamp_ntz, cp string, cs string, clt timestamp_ntz, n int"


def test_second_load_keeps_what_it_does_not_carry(spark):
    plan = spark.createDataFrame([("a", T(2024, 1, 1, 10, 0)), ("b", T(2024, 1, 1, 11, 0))], "stop_id string, planned_time timestamp_ntz")
    updates = [("a", T(2024, 1, 1, 10, 7), "5", None, None, 1), ("a", None, "6", None, None, 2),
               ("b", None, None, "c", T(2024, 1, 1, 10, 0), 1), ("b", T(2024, 1, 1, 11, 30), None, None, None, 2)]
    frame = lambda rows: spark.createDataFrame(rows, UPDATES)
    once = update_merge_coalesce(plan, frame(updates), ["stop_id"], ["n"])
    twice = update_merge_coalesce(plan, frame([u for u in updates if u[-1] == 1]), ["stop_id"], ["n"])
    twice = update_merge_coalesce(twice, frame([u for u in updates if u[-1] == 2]), ["stop_id"], ["n"])
    rows = {r.stop_id: r for r in twice.collect()}
    assert rows == {r.stop_id: r for r in once.collect()}
    assert (rows["a"].actual_time, rows["a"].actual_platform, rows["a"].delay_minutes) == (T(2024, 1, 1, 10, 7), "6", 7)
    assert rows["b"].is_canceled and rows["b"].delay_minutes == 30


def test_counted_load(spark):
    plan = spark.createDataFrame([("a", T(2024, 1, 1)), ("b", T(2024, 1, 1))], "stop_id string, planned_time timestamp_ntz")
    rows = [("a", None, "1", None, None, 1), ("a", None, "2", None, None, 2), ("x", None, "1", None, None, 1), ("b", None, None, None, None, 1)]
    merged, counts = counted_load(plan, spark.createDataFrame(rows, UPDATES), ["stop_id"], ["n"])
    assert counts == {"n_rows": 2, "n_updated": 1, "n_updates": 3, "n_without_row": 1}
    want = update_merge_coalesce(plan, spark.createDataFrame(rows, UPDATES), ["stop_id"], ["n"])
    assert sorted(map(str, merged.collect())) == sorted(map(str, want.collect()))
    assert counted_load(plan.limit(0), spark.createDataFrame([], UPDATES), ["stop_id"], ["n"])[1] == dict.fromkeys(counts, 0)


def test_one_rule_for_trains(spark):
    stops = spark.createDataFrame([("S", "5A", "o", 1), ("S", "5", "o", 2), (None, "7", "o", 3), ("S", None, "o", 4)],
                                  "category string, number string, owner string, seen_order int")
    trains, rejects = train_dimension(stops), train_rejects(stops)
    assert [r.train_id for r in trains.collect()] == ["S-5"] and rejects.count() == 3
    facts = stops.filter(has_train(F.col("category"), F.col("number"))).select(F.concat_ws("-", "category", "number").alias("train_id"))
    assert C.fk_orphans(facts, trains, "train_id", "train_id").count() == 0


def test_fact_foreign_keys(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (None, "c")], "s int, t string")
    dims = {"s": spark.createDataFrame([(1,)], "s int"), "t": spark.createDataFrame([("a",), ("b",)], "t string")}
    assert {r.column_name: r.n_orphans for r in C.fact_fk_orphans(fact, dims).collect()} == {"s": 2, "t": 1}


def test_surrogate_key_tells_nulls_and_text_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "null"), (None, "a")], "x string, y string")
    assert with_surrogate_key(df, ["x", "y"], "k").select("k").distinct().count() == 4


def test_chain_deeper_than_any_limit(spark):
    n = 40
    edges = spark.range(n - 1).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    stations = spark.range(n).select(F.col("id").alias("station_id"), F.format_string("s%02d", F.col("id")).alias("station_name"))
    request = spark.createDataFrame([(1, "s00", "s39"), (2, "s05", "s07"), (3, "s39", "s00")],
                                    "request_id int, origin_name string, destination_name string")
    got = {r.request_id: (r.hops, r.status) for r in G.shortest_hops(request, edges, stations).collect()}
    assert got[1] == (39, "ok") and got[2] == (2, "ok") and got[3][0] is None


def test_itineraries_without_a_buffer_and_edges_that_take_no_time(spark):
    """Against Dijkstra on a graph with circles of zero minutes."""
    r = random.Random(5)
    minute = lambda m: T(2024, 1, 1, 8) + dt.timedelta(minutes=m)
    edges = [(k, r.randrange(12), r.randrange(12), m := r.randrange(0, 40, 4), m + r.choice([0, 0, 4, 8])) for k in range(260)]
    edges = [(k, u, v, minute(a), minute(b)) for k, u, v, a, b in edges if u != v]
    frame = spark.createDataFrame(edges, "train_id long, u int, v int, dep timestamp_ntz, arr timestamp_ntz")
    stations = spark.createDataFrame([(k, f"s{k}") for k in range(13)], "station_id int, station_name string")
    asked = [(100 * o + d, f"s{o}", f"s{d}", "2024-01-01 08:00") for o in (0, 5) for d in range(13)]
    requests = spark.createDataFrame(asked, "request_id int, origin_name string, destination_name string, depart_text string")
    got = {x.request_id: (x.arrival, x.itinerary) for x in G.itineraries(requests, frame, stations, buffer_minutes=0).collect()}
    for o in (0, 5):
        best, todo = {o: minute(0)}, [(minute(0), o)]
        while todo:
            t, u = heapq.heappop(todo)
            for _, a, v, dep, arr in edges:
                if a == u and dep >= t and arr < best.get(v, minute(999)):
                    best[v] = arr
                    heapq.heappush(todo, (arr, v))
        for d in range(13):
            if d not in best:
                assert 100 * o + d not in got
                continue
            arrival, text = got[100 * o + d]
            assert arrival == best[d] and text.endswith(f"s{d} arr {arrival:%H:%M}")
            # Every leg is an edge that is there, in time, and leads on to the next.
            legs = [x.split() for x in text.split(" -> ")]
            at, now = o, "08:00"
            for leg, after in zip(legs, legs[1:]):
                k = int(leg[2][1:-1])
                _, u, v, dep, arr = next(e for e in edges if e[0] == k)
                assert leg[0] == f"s{u}" == f"s{at}" and leg[1] == f"{dep:%H:%M}" >= now and after[0] == f"s{v}"
                at, now = v, f"{arr:%H:%M}"
            assert at == d and len(legs) <= 13


def test_spans_of_dates_do_not_matter(spark):
    """Date by date or all at once, with sources that start on different days, and goals that end a search early."""
    r = random.Random(6)
    hour = lambda h: T(2024, 1, 1) + dt.timedelta(hours=h)
    edges = [(r.randrange(15), r.randrange(15), hour(h := r.randrange(0, 240)), hour(h + r.randrange(1, 40))) for _ in range(400)]
    frame = G.dated_edges(spark.createDataFrame(edges, "u int, v int, dep timestamp_ntz, arr timestamp_ntz"))
    sources = spark.createDataFrame([(o, hour(h)) for o in (1, 2, 9) for h in (0, 30, 130, 500)], "origin_id int, depart_ts timestamp_ntz")
    labels = lambda n, goals=None: {tuple(x[:3]): x[3] for x in G.source_labels(sources, frame, 2, goals, n).collect()}
    whole = labels(10 ** 9)
    assert labels(1) == whole and len(whole) > 60
    goals = sources.crossJoin(spark.createDataFrame([(3,), (7,)], "destination_id int"))  # two stations
    for n in (1, 3000, 10 ** 9):
        some = labels(n, goals)
        assert all(some.get((o, t, d)) == whole.get((o, t, d)) for o, t, _ in whole for d in (3, 7))


def test_minutes_of_a_crowded_hour_are_ordered_apart(spark):
    rows = [(1, i % 7, i % 2 == 1, T(2024, 1, 1, 8, i // 10), i) for i in range(300)]
    m = spark.createDataFrame(rows, "train_id int, station_id int, is_arrival boolean, planned_time timestamp_ntz, tie int")
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(G.build_edges(m, hour_rows=20)) == key(G.build_edges(m)) != []


def test_nearest_with_a_far_point_and_a_dense_cluster(spark):
    stations = spark.range(3000).select(
        F.col("id").alias("station_id"), F.format_string("n%d", F.col("id")).alias("station_name"),
        F.when(F.col("id") < 2500, 0.5 + F.rand(1) * 1e-5).otherwise(F.rand(2)).alias("latitude"),
        F.when(F.col("id") < 2500, 0.5 + F.rand(3) * 1e-5).otherwise(F.rand(4)).alias("longitude"))
    stations = session.write_table(stations, "test-stations")
    points = spark.range(60).select(F.col("id").alias("point_id"), F.rand(5).alias("latitude"), F.rand(6).alias("longitude")) \
        .unionByName(spark.createDataFrame([(100, 250.0, -90.0), (101, 0.500003, 0.500004)], "point_id long, latitude double, longitude double"))
    points = session.write_table(points, "test-points")
    got = {r.point_id: r.station_id for r in nearest_station_per_point(points, stations).collect()}
    brute = points.crossJoin(stations.toDF("station_id", "station_name", "a", "b")) \
        .withColumn("d", F.pow(F.col("a") - F.col("latitude"), 2) + F.pow(F.col("b") - F.col("longitude"), 2)) \
        .groupBy("point_id").agg(F.min_by("station_id", F.struct("d", "station_id")).alias("s"))  # a small fixture only
    assert got == {r.point_id: r.s for r in brute.collect()}


def test_cells_follow_the_occupancy(spark):
    """A stray place far away, and places that come ever closer together."""
    square = spark.range(100_000).select(F.rand(7).alias("latitude"), F.rand(8).alias("longitude"), F.col("id"))
    stray = spark.createDataFrame([(1000.0, 1000.0, -1)], "latitude double, longitude double, id long")
    closer = spark.range(40).select(F.pow(F.lit(2.0), -F.col("id")).alias("latitude"), F.lit(5.0).alias("longitude"), (-2 - F.col("id")).alias("id"))
    places = session.write_table(square.unionByName(stray).unionByName(closer), "test-places")
    levels, leaves = cell_tree(places)
    cells = leaves.groupBy("cell").count()
    assert cells.agg(F.max("count")).first()[0] <= LEAF_PLACES and leaves.count() == 100_041 and len(levels) < 25
    points = spark.createDataFrame([(1, 999.0, 999.0), (2, 0.0, 5.0), (3, -70.0, 0.5), (4, 0.25, 0.75)], "point_id long, latitude double, longitude double")
    stations = session.write_table(places.select(F.col("id").alias("station_id"), F.lit("n").alias("station_name"), "latitude", "longitude"), "test-stations")
    got = {r.point_id: r.station_id for r in nearest_station_per_point(points, stations).collect()}
    brute = points.crossJoin(stations.toDF("station_id", "station_name", "a", "b")).withColumn(
        "d", F.pow(F.col("a") - F.col("latitude"), 2) + F.pow(F.col("b") - F.col("longitude"), 2)) \
        .groupBy("point_id").agg(F.min_by("station_id", F.struct("d", "station_id")).alias("s"))  # four points
    assert got == {r.point_id: r.s for r in brute.collect()} and got[1] == -1 and got[2] == -41


def test_fuzzy_join_of_many_names_with_common_grams(spark):
    names = spark.range(3000).select(F.col("id").alias("station_id"), F.format_string("platform street %d", F.col("id") * 37).alias("station_name"))
    probes = spark.createDataFrame([("platform str 370",), ("platfrom street 99",), ("zzz",)], "q string")
    fast = {(r.q, r.station_id) for r in fuzzy_candidates(probes, "q", names).collect()}
    brute = {(r.q, r.station_id) for r in pair_similarity(probes.crossJoin(names).select("q", "station_name"), "q", "station_name")
             .join(names, "station_name").filter("n_shared * 5 > n_union * 2").collect()}
    assert fast == brute and fast


def test_a_gram_of_half_the_names_is_dealt_out(spark):
    """100,000 names of which half share a gram, and some probes that have it."""
    from railyard.operators.resolve import dealt_by_gram
    stations = spark.range(100_000).select(
        F.col("id").alias("s_key"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.format_string("g%d", F.col("id") % 25_000)).alias("gram"))
    probes = spark.range(30).select(F.col("id").alias("p_key"), F.when(F.col("id") < 20, "hot").otherwise(F.format_string("g%d", F.col("id"))).alias("gram"))
    p, s, on = dealt_by_gram(probes, stations)
    assert on == ["gram", "p_part", "s_part"] and s.count() == 100_000
    plain = probes.join(stations, "gram").select("p_key", "s_key")
    assert sorted(map(tuple, p.join(s, on).select("p_key", "s_key").collect())) == sorted(map(tuple, plain.collect()))
    heaviest = sorted(r["count"] for r in s.filter("gram = 'hot'").groupBy(*on).count().collect())
    assert len(heaviest) == 5 and heaviest[-1] <= 2 * heaviest[2] and heaviest[-1] < 11_000
    # Where a gram is common on both sides, both are dealt out.
    many = spark.range(35_000).select(F.col("id").alias("p_key"), F.lit("hot").alias("gram"))
    p, s, on = dealt_by_gram(many, stations)
    assert p.groupBy(*on).count().agg(F.max("count")).first()[0] < 11_000 and p.count() == 35_000 * 5 and s.filter("gram = 'hot'").count() == 50_000 * 4
    assert dealt_by_gram(probes.filter("gram <> 'hot'"), stations)[2] == ["gram"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_tables_can_be_dropped(spark):
    import os
    table = session.write_table(spark.range(3), "test-drop")
    folder = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    assert os.path.isdir(folder)
    session.drop_table(table)
    assert not os.path.exists(folder)


def test_sql_frames_leave_the_callers_views_alone(spark):
    spark.range(5).createOrReplaceTempView("mine")
    got = run_sql(spark, "SELECT count(*) AS n FROM mine WHERE id < :most;", {"most": 2}, {"mine": spark.range(100)})
    assert got.first().n == 2 and spark.table("mine").count() == 5
    spark.catalog.dropTempView("mine")


def test_star_tables_are_typed_checked_and_replaced(spark, tmp_dir):
    from railyard.sources import star
    stations = spark.createDataFrame([(1, "A", 52.1234567, 13.0), (2, "B", None, None)], "station_id int, station_name string, latitude double, longitude double")
    fact = spark.createDataFrame([(1, 5, "S-1", "x", True), (2, 5, "S-1", "x", True), (2, 6, "S-1", "y", False)],
                                 "station_id long, time_id int, train_id string, stop_id string, is_arrival boolean")
    got = star.write_star_table(stations, tmp_dir, "dim_station")
    assert str(got.orderBy("station_id").first().latitude) == "52.123457"
    star.write_star_table(fact, tmp_dir, star.FACT)
    with pytest.raises(ValueError, match="repeated"):
        star.write_star_table(fact.unionByName(fact), tmp_dir, star.FACT)
    with pytest.raises(ValueError, match="station_name"):
        star.write_star_table(stations.drop("station_name"), tmp_dir, "dim_station")
    lost = star.replace_dimension(stations.filter("station_id = 2"), tmp_dir, "dim_station")
    assert [r.station_id for r in lost.collect()] == [1]
    assert star.read_star_table(spark, tmp_dir, star.FACT).count() == 2
