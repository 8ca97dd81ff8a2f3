"""Transport graph and route search.

Searches are batched: a request table goes in, every request advances one
level per round, and each round is a couple of joins and aggregates. Each
round's state is written as a Parquet table in the shared checkpoint folder
(``spark.checkpoint.dir``), which cuts plan and lineage growth and survives
executor loss; static inputs (edges, adjacency, resolved requests) are
written once the same way. The driver sees one row of measures per round; which
side of a join is broadcast is left to the planner, which knows the bytes of a
written table. No search has a limit of rounds: an empty frontier ends it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from railyard.constants import (ITINERARY_TIME_FORMAT, STATUS_NO_CONNECTION, STATUS_NOT_FOUND, STATUS_OK,
                                TRANSFER_BUFFER_MINUTES)
from railyard.functions.timefmt import parse_route_time
from railyard.operators.latest import latest_per_key
from railyard.session import checkpoint_dir, debug, drop_table, write_table, write_table_metrics, write_table_observed

# Rows of a train's hour above which its minutes are ordered apart.
HOUR_ROWS = 100_000
# Rounds after which the tables that a search appends are made one again, and joins after which a plan is cut.
COMPACT_ROUNDS, PLAN_ROUNDS = 8, 4
# Sources times edges up to which several departure dates are settled together, and hops of a round (one job).
RELAXATIONS, HOPS_PER_ROUND = 5_000_000, 2
SOURCE = ["origin_id", "depart_ts"]
GOAL = [*SOURCE, "destination_id"]
LABEL = [*SOURCE, "station_id"]
STATE = [*LABEL, "bound", "arrival", "fresh"]


# --- G1 / G2 / A12: graph construction ----------------------------------------------

def window_movements(movements: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Half-open planned-time window ``[start, end)`` (pushed to the scan); without bounds the whole table."""
    t = F.col("planned_time")
    m = movements if start is None else movements.filter(t >= F.lit(start).cast("timestamp_ntz"))
    return m if end is None else m.filter(t < F.lit(end).cast("timestamp_ntz"))


def next_in_sequence(df: DataFrame, key: str, order: list[str], payload: list[str],
                     bucket: Column) -> DataFrame:
    """Attach ``nxt`` (struct of ``payload``) = the next row of the same ``key`` by ``order``.

    Two levels keep a key with a huge share of rows from landing in one task:
    ``lead`` runs per (key, bucket) -- buckets are a coarse function of the
    leading order column -- and the last row of a bucket takes the first row of
    the key's next non-empty bucket, found on a one-row-per-(key, bucket)
    summary that is built with a partial aggregate.
    """
    b = df.withColumn("_bk", bucket)
    row = F.struct(*[F.col(c) for c in order + payload])
    w = Window.partitionBy(key, "_bk").orderBy(*order)
    inner = b.withColumn("_nx", F.lead(row).over(w))
    firsts = b.groupBy(key, "_bk").agg(F.min(row).alias("_first"))
    wb = Window.partitionBy(key).orderBy("_bk")
    nxt_first = firsts.select(key, "_bk", F.lead("_first").over(wb).alias("_nb"))
    out = inner.join(nxt_first, [key, "_bk"], "left")
    return out.withColumn("nxt", F.coalesce(F.col("_nx"), F.col("_nb"))).drop("_nx", "_nb", "_bk")


def build_edges(movements: DataFrame, start: str | None = None, end: str | None = None,
                hour_rows: int = HOUR_ROWS) -> DataFrame:
    """Connections ``(train_id, u, v, dep, arr)``: a departure row followed directly
    (same train, by planned time then ``tie``) by an arrival row at another station.

    A train's rows are ordered hour by hour, and minute by minute in hours
    with more than ``hour_rows`` rows.
    """
    m = window_movements(movements, start, end).select("train_id", "station_id", "is_arrival", "planned_time", "tie")
    # Buckets are minutes since a fixed origin, so they are monotone in time and free of the session time zone.
    minute = F.timestamp_diff("MINUTE", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), F.col("planned_time"))
    hour = F.floor(minute / 60)
    m = m.withColumn("_minute", minute).withColumn("_hour", hour)
    crowded = m.groupBy("train_id", "_hour").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hour_rows)
    m = m.join(crowded, ["train_id", "_hour"], "left")
    seq = next_in_sequence(m.drop("_hour"), "train_id", ["planned_time", "tie"], ["station_id", "is_arrival"],
                           F.when(F.col("_n").isNull(), F.floor(F.col("_minute") / 60) * 60).otherwise(F.col("_minute")))
    e = seq.filter((~F.col("is_arrival")) & F.col("nxt.is_arrival") & (F.col("station_id") != F.col("nxt.station_id")))
    return e.select("train_id", F.col("station_id").alias("u"), F.col("nxt.station_id").alias("v"),
                    F.col("planned_time").alias("dep"), F.col("nxt.planned_time").alias("arr"))


def fact_movements(fact: DataFrame, keys: list[str], snapshot_order: list[str]) -> DataFrame:
    """Movements of a fact with a row per snapshot: each stop event as its latest snapshot has it.

    At one minute a train's arrivals come before its departures, then stops by id.
    """
    now = latest_per_key(fact, keys, snapshot_order)
    return now.select("train_id", "station_id", "is_arrival", "planned_time",
                      F.struct(~F.col("is_arrival"), F.col("stop_id")).alias("tie"))


def adjacency(edges: DataFrame) -> DataFrame:
    """Static directed adjacency: distinct (u, v)."""
    return edges.select("u", "v").distinct()


def time_range(movements: DataFrame, start: str | None = None, end: str | None = None,
               edges: DataFrame | None = None) -> DataFrame:
    """True min / max planned time and row count of the loaded window (plus edge count)."""
    m = window_movements(movements, start, end)
    r = m.agg(F.min("planned_time").alias("min_time"), F.max("planned_time").alias("max_time"),
              F.count(F.lit(1)).alias("n_movements"))
    if edges is not None:
        n = edges.agg(F.count(F.lit(1)).alias("n_edges"))
        r = r.crossJoin(n)  # two aggregates of one row each
    return r


# --- J13: endpoint resolution --------------------------------------------------------

def name_index(stations: DataFrame) -> DataFrame:
    """One id per name; with duplicate names the largest id wins (last loaded)."""
    return stations.groupBy("station_name").agg(F.max("station_id").alias("station_id"))


def resolve_endpoints(requests: DataFrame, stations: DataFrame) -> DataFrame:
    idx = write_table(name_index(stations), "station-names")  # used for both ends
    o = idx.select(F.col("station_name").alias("origin_name"), F.col("station_id").alias("origin_id"))
    d = idx.select(F.col("station_name").alias("destination_name"), F.col("station_id").alias("destination_id"))
    return requests.join(o, "origin_name", "left").join(d, "destination_name", "left")


# --- G3: fewest hops -------------------------------------------------------------------

def bfs_tree(adj: DataFrame, stations: DataFrame, origins: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Level-synchronous BFS from every origin: ``origin_id, station_id, hops, parent_id, place``.

    The parent is the one on the lexicographically smallest shortest path. Of an
    origin's stations on one level those paths are ordered by the parent's
    place, then by the station's name, so a station needs no more than its
    ``place`` in that order (a number that grows along one sort of the level) and
    rows stay narrow however long the paths are. Only the new frontier is joined each round. With
    ``targets`` (``origin_id, destination_id``) an origin stops once its
    destinations are reached. The search ends when a level finds nothing new.
    """
    checkpoint_dir(adj.sparkSession)
    names = name_index(stations).select(F.col("station_id").alias("v"), F.col("station_name").alias("v_name"))
    adj_named = write_table(adj.join(names, "v").select(F.col("u"), F.col("v"), "v_name"), "bfs-adjacency")
    start = (origins.select(F.col("origin_id")).distinct().join(names.select(F.col("v").alias("origin_id")), "origin_id")
             .select("origin_id", F.col("origin_id").alias("station_id"), F.lit(0).alias("hops"),
                     F.col("origin_id").alias("parent_id"), F.lit(0).cast("long").alias("place")))
    visited = frontier = write_table(start, "bfs-level")
    level, n = 0, 1
    while n:
        level += 1
        now = frontier
        if targets is not None:
            reached = visited.select("origin_id", F.col("station_id").alias("destination_id"))
            missing = targets.join(reached, ["origin_id", "destination_id"], "left_anti").select("origin_id").distinct()
            now = frontier.join(missing, "origin_id", "left_semi")
        cand = (now.join(adj_named, now["station_id"] == adj_named["u"])
                .groupBy("origin_id", F.col("v").alias("station_id"), "v_name")
                .agg(F.min(F.struct("place", F.col("u").alias("parent_id"))).alias("by")))
        fresh = cand.join(visited.select("origin_id", "station_id"), ["origin_id", "station_id"], "left_anti")
        frontier, n = write_table_observed(
            fresh.orderBy("origin_id", "by.place", "v_name")
            .select("origin_id", "station_id", F.lit(level).alias("hops"), F.col("by.parent_id").alias("parent_id"),
                    F.monotonically_increasing_id().alias("place")), "bfs-level")
        debug(f"bfs level {level}: {n} new")
        # Visited = union of the level tables, made one table again every few levels.
        visited = visited.unionByName(frontier)
        if level % COMPACT_ROUNDS == 0:
            visited = write_table(visited, "bfs-visited")
    return visited


def tree_paths(tree: DataFrame, stations: DataFrame, pairs: DataFrame) -> DataFrame:
    """``origin_id, destination_id, hops, path`` of the pairs that the tree reaches, ``path`` an array of names.

    All pairs walk up together, one row per pair and step, and the names are put together once at the end.
    """
    ends = tree.select("origin_id", F.col("station_id").alias("destination_id"), "hops", "parent_id")
    now, most = write_table_observed(pairs.distinct().join(ends, ["origin_id", "destination_id"]).select(
        "origin_id", "destination_id", "hops", F.col("hops").alias("at"), F.col("destination_id").alias("station_id"), "parent_id"),
        "bfs-path", F.max("hops"))
    up = tree.select("origin_id", F.col("station_id").alias("parent_id"), F.col("parent_id").alias("above"))
    steps = now
    for k in range(1, most + 1):
        now = now.filter(F.col("at") > 0).join(up, ["origin_id", "parent_id"]).select(
            "origin_id", "destination_id", "hops", (F.col("at") - 1).alias("at"), F.col("parent_id").alias("station_id"),
            F.col("above").alias("parent_id"))
        now = write_table(now, "bfs-path") if k % PLAN_ROUNDS == 0 else now
        steps = steps.unionByName(now)
    named = steps.join(name_index(stations), "station_id")
    by = F.array_sort(F.collect_list(F.struct("at", "station_name")))
    return named.groupBy("origin_id", "destination_id", "hops").agg(F.transform(by, lambda x: x["station_name"]).alias("path"))


def bfs_paths(adj: DataFrame, stations: DataFrame, origins: DataFrame) -> DataFrame:
    """``origin_id, station_id, hops, path`` for every station that an origin reaches."""
    tree = bfs_tree(adj, stations, origins)
    pairs = tree.select("origin_id", F.col("station_id").alias("destination_id"))
    return tree_paths(tree, stations, pairs).withColumnRenamed("destination_id", "station_id")


def shortest_hops(requests: DataFrame, adj: DataFrame, stations: DataFrame) -> DataFrame:
    """Per request: ``hops``, ``path`` (names joined by ' -> ') and ``status``."""
    r = write_table(resolve_endpoints(requests, stations), "hop-requests")
    ok = r.filter(F.col("origin_id").isNotNull() & F.col("destination_id").isNotNull())
    pairs = ok.select("origin_id", "destination_id").distinct()
    paths = tree_paths(bfs_tree(adj, stations, ok.select("origin_id"), pairs), stations, pairs)
    j = r.join(paths, ["origin_id", "destination_id"], "left")
    status = (F.when(F.col("origin_id").isNull() | F.col("destination_id").isNull(), F.lit(STATUS_NOT_FOUND))
              .when(F.col("hops").isNull(), F.lit(STATUS_NO_CONNECTION)).otherwise(F.lit(STATUS_OK)))
    return j.select("request_id", "origin_name", "destination_name", "hops",
                    F.array_join("path", " -> ").alias("path"), status.alias("status"))


# --- G4: earliest arrival -------------------------------------------------------------

def dated_edges(edges: DataFrame) -> DataFrame:
    """Edges written once, a folder per departure date, so that a search scans only the dates it can still use."""
    train = F.col("train_id").cast("bigint") if "train_id" in edges.columns else F.lit(None).cast("bigint")
    e = edges.select("u", "v", "dep", "arr", train.alias("train_id"), F.to_date("dep").alias("dep_date"))
    return write_table(e.hint("rebalance", "dep_date"), "dated-edges", partition_by="dep_date")


def _due(end) -> str:
    """Labels from which departures before ``end`` can be caught."""
    return "true" if end is None else f"arrival < TIMESTAMP_NTZ '{end} 00:00:00'"


def quickest_edges(edges: DataFrame) -> DataFrame:
    """Of the edges of a pair of stations on a date those that a search can need: none that departs later arrives as early.

    A label takes one of them: that with ``dep`` at or after the time it is ready, and ``prev`` (the departure of
    the one before, null for the date's first) before it. Written once, a folder per date.
    """
    e = edges if "dep_date" in edges.columns else edges.withColumn("dep_date", F.to_date("dep"))
    pair = ["dep_date", "u", "v"]
    first = e.filter("dep IS NOT NULL AND arr IS NOT NULL").groupBy(*pair, "dep").agg(F.min("arr").alias("arr"))
    later = F.min("arr").over(Window.partitionBy(*pair).orderBy(F.desc("dep")).rowsBetween(Window.unboundedPreceding, -1))
    front = first.withColumn("later", later).filter("later IS NULL OR arr < later")
    prev = F.lag("dep").over(Window.partitionBy(*pair).orderBy("dep"))
    return write_table(front.select("u", "v", "dep", "arr", prev.alias("prev"), "dep_date").hint("rebalance", "dep_date"),
                       "quickest-edges", partition_by="dep_date")


def _relaxed(state: DataFrame, usable: DataFrame, due: str, buffer_minutes: int) -> DataFrame:
    """The state after its fresh labels have taken every usable edge; fresh are then the labels that got better.

    Arrivals are compared as plain times, which an aggregate keeps in a hash map without sorting what the join finds.
    """
    ready = f"CASE WHEN station_id = origin_id THEN arrival ELSE arrival + INTERVAL '{buffer_minutes}' MINUTE END"
    found = state.filter("fresh").selectExpr(*SOURCE, "station_id AS u", "bound", f"{ready} AS ready").join(usable, "u") \
        .filter("dep >= ready AND (prev IS NULL OR prev < ready) AND (bound IS NULL OR arr < bound)") \
        .selectExpr(*SOURCE, "v AS station_id", "bound", "CAST(NULL AS TIMESTAMP_NTZ) AS known", "arr AS found")
    known = state.selectExpr(*LABEL, "bound", "arrival AS known", "CAST(NULL AS TIMESTAMP_NTZ) AS found")
    best = known.unionByName(found).groupBy(*LABEL, "bound").agg(F.min("known").alias("known"), F.min("found").alias("found"))
    return best.selectExpr(*LABEL, "bound", "least(known, found) AS arrival", "found IS NOT NULL AND (known IS NULL OR found < known) AS better") \
        .selectExpr(*LABEL, "bound", "arrival", f"better AND {due} AS fresh")


def source_labels(sources: DataFrame, edges: DataFrame, buffer_minutes: int = TRANSFER_BUFFER_MINUTES,
                  goals: DataFrame | None = None, relaxations: int = RELAXATIONS) -> DataFrame:
    """Earliest arrivals ``origin_id, depart_ts, station_id, arrival`` of all ``sources`` (``origin_id, depart_ts``) at once.

    Departure dates are settled in order. A span of dates holds one date, or as
    many as keep sources times edges within ``relaxations``; its edges are read
    in the rounds of that span only, without those that ``quickest_edges`` leaves out: all labels before its end take them, then
    the labels that got better, until nothing improves. As no edge departs
    before the span, what arrives before its end is final.

    With ``goals`` (sources and ``destination_id``) a source takes no part in later
    spans once its goals are settled, and only labels before its latest goal's
    are looked for; labels are then complete on the ways to the goals only.
    """
    checkpoint_dir(sources.sparkSession)
    edges = quickest_edges(edges)
    start = sources.select(*SOURCE).distinct().select(*SOURCE, F.col("origin_id").alias("station_id"), F.lit(None).cast("timestamp_ntz").alias("bound"),
                                                      F.col("depart_ts").alias("arrival"), F.lit(True).alias("fresh"))
    written, seen = write_table_metrics(start, "ea-labels", n=F.count(F.lit(1)), first=F.min("arrival"))
    state, n_open = written, seen["n"]
    # A row per date of the loaded window.
    dates = sorted((r["dep_date"], r["n"]) for r in edges.groupBy("dep_date").agg(F.count(F.lit(1)).alias("n")).collect())
    dates = [x for x in dates if n_open and x[0] >= seen["first"].date()]
    at = 0
    while at < len(dates) and n_open:
        to, n_edges = at + 1, dates[at][1]
        while to < len(dates) and n_open * (n_edges + dates[to][1]) <= relaxations:
            n_edges, to = n_edges + dates[to][1], to + 1
        end = dates[to][0] if to < len(dates) else None
        usable = edges.filter(F.col("dep_date").between(F.lit(dates[at][0]), F.lit(dates[to - 1][0]))).select("u", "v", "dep", "arr", "prev")
        if at == 0 or goals is None:
            state = state.withColumn("fresh", F.expr(_due(end)))
        else:  # sources without a row have their goals
            state = state.drop("bound").join(still_open, SOURCE, "left").withColumn(
                "fresh", F.expr(f"{_due(end)} AND open IS NOT NULL AND (bound IS NULL OR arrival < bound)")).select(*STATE)
        better = 1
        while better:
            for _ in range(HOPS_PER_ROUND):
                state = _relaxed(state, usable, _due(end), buffer_minutes)
            state, seen = write_table_metrics(state, "ea-labels", n=F.count_if("fresh"))
            drop_table(written)  # the round before; its labels are all in the new state
            written, better = state, seen["n"]
            debug(f"earliest arrival, dates to {dates[to - 1][0]}: {better} to go on from")
        at = to
        if goals is not None and at < len(dates):
            reached = goals.join(state.select(*SOURCE, F.col("station_id").alias("destination_id"), "arrival"), [*SOURCE, "destination_id"], "left")
            open_now = reached.groupBy(*SOURCE).agg(
                F.when(F.count("arrival") == F.count(F.lit(1)), F.max("arrival")).alias("bound"), F.lit(True).alias("open")) \
                .filter(F.col("bound").isNull() | (F.col("bound") >= F.lit(end)))
            still_open, n_open = write_table_observed(open_now, "ea-open")
    return state.select(*LABEL, "arrival")


def earliest_arrival_labels(starts: DataFrame, edges: DataFrame, buffer_minutes: int = TRANSFER_BUFFER_MINUTES) -> DataFrame:
    """``request_id, origin_id, station_id, arrival`` of requests, of which equal (origin, departure) are searched once.

    ``starts``: request_id, origin_id, depart_ts and, if only the way to it is
    wanted, destination_id. The arrival is the earliest at each reachable station, or with a
    destination at those on a way to it. An edge (u, v, dep, arr) is usable when
    ``dep >= label(u)`` at the origin and ``dep >= label(u) + buffer`` elsewhere.
    """
    goals = starts.select(*SOURCE, "destination_id").distinct() if "destination_id" in starts.columns else None
    labels = source_labels(starts, edges, buffer_minutes, goals)
    return starts.select("request_id", *SOURCE).join(labels, SOURCE).select("request_id", "origin_id", "station_id", "arrival")


def route_starts(requests: DataFrame, stations: DataFrame) -> DataFrame:
    """Requests with resolved endpoint ids and parsed departure, materialised once (one row per request)."""
    r = resolve_endpoints(requests, stations)
    if "depart_text" in requests.columns:
        r = r.withColumn("depart_ts", parse_route_time("depart_text"))
    return write_table(r, "route-requests")


def wanted(starts: DataFrame) -> DataFrame:
    """Distinct ``origin_id, depart_ts, destination_id`` of the requests in which all three are known."""
    return starts.select(*GOAL).filter(" AND ".join(f"{c} IS NOT NULL" for c in GOAL)).distinct()


def earliest_arrival(requests: DataFrame, edges: DataFrame, stations: DataFrame,
                     buffer_minutes: int = TRANSFER_BUFFER_MINUTES) -> DataFrame:
    """Per request: earliest ``arrival`` at the destination and ``status``."""
    r = route_starts(requests, stations)
    goals = wanted(r)
    labels = source_labels(goals, edges, buffer_minutes, goals)
    j = r.join(labels.withColumnRenamed("station_id", "destination_id"), [*SOURCE, "destination_id"], "left")
    status = (F.when(F.col("origin_id").isNull() | F.col("destination_id").isNull(), F.lit(STATUS_NOT_FOUND))
              .when(F.col("arrival").isNull(), F.lit(STATUS_NO_CONNECTION)).otherwise(F.lit(STATUS_OK)))
    return j.select("request_id", "origin_name", "destination_name", "depart_ts", "arrival", status.alias("status"))


# --- G5: itinerary --------------------------------------------------------------------

def settled_hops(labels: DataFrame, edges: DataFrame, buf: Column) -> DataFrame:
    """Labels with ``hops``: the fewest edges over which the label is reached along other stations' labels.

    Edges that take no time may lead round in a circle of equal labels; with
    the hops a way back always has a station to go to that is nearer its origin.
    """
    lab = labels.select(*LABEL, "arrival")
    level = write_table(lab.filter(F.col("station_id") == F.col("origin_id")).withColumn("hops", F.lit(0)), "ea-hops")
    known, n, k = level, 1, 0
    while n:
        k += 1
        to = lab.select(*SOURCE, F.col("station_id").alias("v"), F.col("arrival").alias("arr"))
        ready = F.when(F.col("station_id") == F.col("origin_id"), F.col("arrival")).otherwise(F.col("arrival") + buf)
        next_level = level.withColumn("ready", ready).drop("arrival", "hops").join(
            edges.select("u", "v", "dep", "arr"), F.col("station_id") == F.col("u")).filter("dep >= ready").drop("station_id") \
            .join(to, [*SOURCE, "v", "arr"]).select(*SOURCE, F.col("v").alias("station_id"), F.col("arr").alias("arrival")).distinct() \
            .join(known.select(*LABEL), LABEL, "left_anti").withColumn("hops", F.lit(k))
        level, n = write_table_observed(next_level, "ea-hops")
        known = known.unionByName(level)
        known = write_table(known, "ea-hops") if k % COMPACT_ROUNDS == 0 else known
    return known


def itineraries(requests: DataFrame, edges: DataFrame, stations: DataFrame,
                buffer_minutes: int = TRANSFER_BUFFER_MINUTES) -> DataFrame:
    """Per reachable request: its ``arrival`` and ``itinerary`` as text.

    Walk back from the destination over a canonical predecessor: an edge into
    the current station arriving exactly at its label and departing no earlier
    than the previous station's label (+ buffer away from the origin); among
    those the latest departure, then smallest station id, then smallest train.
    With a buffer labels strictly decrease along the walk; without one, edges
    that take no time are only taken towards fewer ``settled_hops``. So it ends
    at the origin. Equal requests walk once, a step is a row, and the steps are
    put together at the end.
    """
    buf = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(buffer_minutes))
    r = route_starts(requests, stations)
    goals = wanted(r)
    e = dated_edges(edges)
    labels = source_labels(goals, e, buffer_minutes, goals)
    labels = settled_hops(labels, e, buf) if buffer_minutes == 0 else labels.withColumn("hops", F.lit(0))
    from_ = labels.select(*SOURCE, F.col("station_id").alias("u"), F.col("arrival").alias("lab_u"), F.col("hops").alias("hops_u"))
    is_open = F.col("node") != F.col("origin_id")
    reached = write_table(goals.join(labels.withColumnRenamed("station_id", "destination_id"), [*SOURCE, "destination_id"]), "itinerary-goals")
    first = reached.select(*GOAL, F.col("destination_id").alias("node"), F.col("arrival").alias("label"), "hops")
    measures = {"n": F.count_if(is_open), "first": F.min("depart_ts"), "last": F.max("label")}
    now, seen = write_table_metrics(first, "itinerary-walk", **measures)
    legs, k = None, 0
    while seen["n"]:
        k += 1
        usable = e.filter(F.col("dep_date").between(F.lit(seen["first"].date()), F.lit(seen["last"].date())))
        here = now.filter(is_open).select(*GOAL, "node", "label", "hops")
        caught = F.col("dep") >= F.when(F.col("u") == F.col("origin_id"), F.col("lab_u")).otherwise(F.col("lab_u") + buf)
        step = (here.join(usable, (here["node"] == usable["v"]) & (here["label"] == usable["arr"])).join(from_, [*SOURCE, "u"])
                .filter(caught & ((F.col("hops_u") < F.col("hops")) | F.lit(buffer_minutes > 0))))
        rank = F.struct(F.col("dep"), (-F.col("u")).alias("nu"), (-F.col("train_id")).alias("nt"))
        best = step.groupBy(*GOAL).agg(F.max_by(F.struct("u", "lab_u", "hops_u", "dep", "train_id"), rank).alias("b"))
        now, seen = write_table_metrics(best.select(
            *GOAL, F.col("b.u").alias("node"), F.col("b.lab_u").alias("label"), F.col("b.hops_u").alias("hops"),
            F.lit(-k).alias("at"), "b.dep", "b.train_id"), "itinerary-walk", **measures)
        debug(f"itinerary step {k}: {seen['n']} open")
        leg = now.select(*GOAL, "at", F.col("node").alias("station_id"), "dep", "train_id")
        legs = leg if legs is None else legs.unionByName(leg)
    names = name_index(stations)
    out = r.join(reached.select(*GOAL, "arrival"), GOAL)
    if legs is None:
        out = out.withColumn("legs_text", F.lit(None).cast("string"))
    else:
        text = F.concat(F.col("station_name"), F.lit(" "), F.date_format("dep", ITINERARY_TIME_FORMAT),
                        F.lit(" ["), F.col("train_id").cast("string"), F.lit("]"))
        steps = legs.join(names, "station_id", "left").groupBy(*GOAL).agg(
            F.array_sort(F.collect_list(F.struct("at", text.alias("txt")))).alias("steps"))
        out = out.join(steps.select(*GOAL, F.array_join(F.transform("steps", lambda x: x["txt"]), " -> ").alias("legs_text")), GOAL, "left")
    dest = out.join(names.select(F.col("station_id").alias("destination_id"), F.col("station_name").alias("sname")), "destination_id", "left")
    return dest.select("request_id", "arrival",
                       F.concat_ws(" -> ", F.nullif(F.col("legs_text"), F.lit("")),
                                   F.concat(F.col("sname"), F.lit(" arr "),
                                            F.date_format("arrival", ITINERARY_TIME_FORMAT))).alias("itinerary"))


# --- G6: status -----------------------------------------------------------------------

def route_status(results: DataFrame, loaded_range: DataFrame) -> DataFrame:
    """``request_id, status, out_of_range``: a departure outside the loaded window is flagged."""
    j = results.crossJoin(F.broadcast(loaded_range.select("min_time", "max_time")))  # an aggregate of one row
    out = F.coalesce((F.col("depart_ts") < F.col("min_time")) | (F.col("depart_ts") > F.col("max_time")), F.lit(False))
    return j.select("request_id", "status", out.alias("out_of_range"))
