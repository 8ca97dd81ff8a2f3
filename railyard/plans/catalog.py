"""Registry of runnable queries: ``name -> (spark, sf_dir) -> DataFrame`` plus DuckDB twins.

Each query maps the test tables onto the model roles (``roles.py``) and calls
one library operator. Double outputs are rounded to 6 places in both engines so
the cross-engine comparison is about semantics, not the last float bit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.constants import CHANGE_FILE_SUFFIX, PLAN_FILE_SUFFIX
from railyard.functions.movement import cancelled_flag, event_delay, warehouse_delay
from railyard.functions.names import normalize_names, overrides_frame
from railyard.functions.timefmt import format_compact_ts, parse_compact_ts
from railyard.operators import analysis as A
from railyard.operators import checks as C
from railyard.operators import graph as G
from railyard.operators import merge as M
from railyard.operators import resolve as R
from railyard.operators import warehouse as W
from railyard.operators.dims import train_dimension
from railyard.operators.latest import latest_per_key
from railyard.operators.nearest import nearest_station_per_point
from railyard.sources import json as J
from railyard.sources import parquet as P
from railyard.sources import star as S
from railyard.sources import xml as X
from railyard.sources.sql import run_sql
from railyard.sources.timedim import slot_join, slot_misses
from railyard.plans import oracle_views as V
from railyard.plans import roles
from railyard.session import scratch_path
from railyard.streaming import incremental as I

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# Query parameters (one station name, one point, one date+hour, as the reference's demo).
STATION_NAME = "Supplier#000000007"
POINT = (12.0, 3.5)
TARGET_DATE, TARGET_HOUR = "2024-01-03", 12
EVENT_STATION = "42"

# ---------------------------------------------------------------------------
# Step 0/1: analyses and parametrised warehouse queries
# ---------------------------------------------------------------------------


@register("peak_departures", V.with_(V.MOVEMENT_EVENT) + """
SELECT station_name, round(avg(daily_peak_departures), 6) AS avg_peak_departures
FROM (SELECT station_name, event_date, count(*) AS daily_peak_departures
      FROM movement_event WHERE NOT is_arrival AND hour(planned_time) IN (7, 8, 17, 18)
      GROUP BY station_name, event_date)
GROUP BY station_name""")
def q_peak_departures(spark, sf_dir):
    return rounded(A.peak_departures(roles.movement_events(spark, sf_dir)))


@register("peak_departures_daily", V.with_(V.MOVEMENT_EVENT) + """
SELECT station_name, event_date, count(*) AS daily_peak_departures
FROM movement_event WHERE NOT is_arrival AND hour(planned_time) IN (7, 8, 17, 18)
GROUP BY station_name, event_date""")
def q_peak_departures_daily(spark, sf_dir):
    return A.peak_departures_daily(roles.movement_events(spark, sf_dir))


@register("peak_departures_top10", V.with_(V.MOVEMENT_EVENT) + """
SELECT station_name, round(avg(daily_peak_departures), 6) AS avg_peak_departures
FROM (SELECT station_name, event_date, count(*) AS daily_peak_departures
      FROM movement_event WHERE NOT is_arrival AND hour(planned_time) IN (7, 8, 17, 18)
      GROUP BY station_name, event_date)
GROUP BY station_name ORDER BY avg(daily_peak_departures) DESC, station_name LIMIT 10""")
def q_peak_departures_top10(spark, sf_dir):
    return rounded(A.peak_departures_top(roles.movement_events(spark, sf_dir), 10))


@register("daily_avg_delay", V.with_(V.MOVEMENT_EVENT) + f"""
SELECT event_date, round(avg(delay_minutes), 6) AS avg_daily_delay
FROM movement_event WHERE station_name = '{EVENT_STATION}' AND NOT is_canceled
GROUP BY event_date""")
def q_daily_avg_delay(spark, sf_dir):
    return rounded(A.daily_avg_delay(roles.movement_events(spark, sf_dir), EVENT_STATION))


@register("station_lookup", V.with_(V.STATIONS) + f"""
SELECT station_id, station_name, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
FROM stations WHERE station_name = '{STATION_NAME}'""")
def q_station_lookup(spark, sf_dir):
    return rounded(A.station_lookup(roles.stations(spark, sf_dir), STATION_NAME))


@register("nearest_station", V.with_(V.STATIONS) + f"""
SELECT station_name, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
       round(distance_score, 6) AS distance_score
FROM (SELECT *, power(latitude - {POINT[0]}, 2) + power(longitude - {POINT[1]}, 2) AS distance_score FROM stations)
ORDER BY distance_score, station_id LIMIT 1""")
def q_nearest_station(spark, sf_dir):
    return rounded(A.nearest_station(roles.stations(spark, sf_dir), *POINT))


@register("latest_arrival_delay", V.with_(V.SNAPSHOT_MOVEMENTS, V.STATIONS) + f"""
SELECT round(avg(greatest(0, late.m)), 6) AS avg_delay_minutes
FROM (SELECT arg_max({{'m': delay_minutes}}, (l_linenumber, l_shipdate, l_partkey, l_suppkey)) AS late
      FROM snap WHERE is_arrival AND station_id IN (SELECT station_id FROM stations WHERE station_name = '{STATION_NAME}')
      GROUP BY station_id, stop_id)
WHERE late.m IS NOT NULL""")
def q_latest_arrival_delay(spark, sf_dir):
    return rounded(A.latest_arrival_delay(roles.snapshot_movements(spark, sf_dir), roles.stations(spark, sf_dir),
                                          STATION_NAME, order_cols=roles.SNAPSHOT_ORDER))


@register("nearest_station_batch", V.with_(V.STATIONS, V.POINTS) + """
SELECT point_id, station_id, station_name, round(distance_score, 6) AS distance_score
FROM (SELECT p.point_id, s.station_id, s.station_name,
             power(s.latitude - p.latitude, 2) + power(s.longitude - p.longitude, 2) AS distance_score,
             row_number() OVER (PARTITION BY p.point_id
                                ORDER BY power(s.latitude - p.latitude, 2) + power(s.longitude - p.longitude, 2),
                                         s.station_id) AS rn
      FROM points p, stations s)
WHERE rn = 1""")
def q_nearest_station_batch(spark, sf_dir):
    return rounded(nearest_station_per_point(roles.points(spark, sf_dir), roles.stations(spark, sf_dir)))


# ---------------------------------------------------------------------------
# Step 2: time slots, trains, scalar functions
# ---------------------------------------------------------------------------


def _slot_fact(spark, sf_dir):
    return slot_join(roles.slotted_events(spark, sf_dir), roles.time_dim(spark, sf_dir))


@register("dim_time", V.with_(V.TIME_DIM) + "SELECT * FROM dim_time")
def q_dim_time(spark, sf_dir):
    return roles.time_dim(spark, sf_dir)


@register("time_slot_join", V.with_(V.TIME_DIM, V.SLOTTED_EVENTS) + """
SELECT f.event_id, t.time_id, f.slot_ts FROM slotted f JOIN dim_time t ON f.slot_ts = t.slot_ts""")
def q_time_slot_join(spark, sf_dir):
    return _slot_fact(spark, sf_dir).select("event_id", "time_id", "slot_ts")


_WORK_SLOTS = "work_slots AS (SELECT slot_ts FROM dim_time WHERE NOT is_weekend)"


@register("slot_misses", V.with_(V.TIME_DIM, V.SLOTTED_EVENTS, _WORK_SLOTS) + """
SELECT event_id, station_id, slot_ts FROM slotted f WHERE NOT EXISTS (SELECT 1 FROM work_slots w WHERE w.slot_ts = f.slot_ts)""")
def q_slot_misses(spark, sf_dir):
    return slot_misses(roles.slotted_events(spark, sf_dir), roles.weekday_time_dim(spark, sf_dir)).select(
        "event_id", "station_id", "slot_ts")


@register("cancellations_at_hour", V.with_(V.TIME_DIM, V.SLOTTED_EVENTS) + f"""
SELECT count(*) AS total_canceled_trains
FROM slotted f JOIN dim_time t ON f.slot_ts = t.slot_ts
WHERE t.date = DATE '{TARGET_DATE}' AND t.hour = {TARGET_HOUR} AND f.is_canceled""")
def q_cancellations_at_hour(spark, sf_dir):
    return A.cancellations_at_hour(_slot_fact(spark, sf_dir), roles.time_dim(spark, sf_dir), TARGET_DATE, TARGET_HOUR)


@register("snapshot_counts", V.with_(V.TIME_DIM, V.SLOTTED_EVENTS) + """
SELECT t.time_id, t.slot_ts, count(*) AS n_movements, count(*) FILTER (WHERE f.is_arrival) AS n_arrivals,
       count(*) FILTER (WHERE f.is_canceled) AS n_canceled
FROM slotted f JOIN dim_time t ON f.slot_ts = t.slot_ts GROUP BY t.time_id, t.slot_ts""")
def q_snapshot_counts(spark, sf_dir):
    return M.snapshot_counts(_slot_fact(spark, sf_dir), ["time_id", "slot_ts"])


@register("latest_snapshot", V.with_(V.SNAPSHOT_MOVEMENTS) + """
SELECT stop_id, is_arrival, station_id, delay_minutes, l_linenumber, l_shipdate, l_partkey, l_suppkey
FROM (SELECT *, row_number() OVER (PARTITION BY stop_id, is_arrival
                 ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM snap)
WHERE rn = 1""")
def q_latest_snapshot(spark, sf_dir):
    return latest_per_key(roles.snapshot_movements(spark, sf_dir), ["stop_id", "is_arrival"], roles.SNAPSHOT_ORDER)


PARAM_SQL_TEXT = """
-- What the newest snapshot says of each arrival at one station, and how late those are on average.
SELECT round(avg(CASE WHEN newest.late > 0 THEN newest.late ELSE 0 END), 6) AS avg_delay_minutes
FROM (
    SELECT max_by(delay_minutes, struct(l_linenumber, l_shipdate, l_partkey, l_suppkey)) AS late
    FROM movements
    WHERE is_arrival AND station_id IN (SELECT station_id FROM stations WHERE station_name = :station_name)
    GROUP BY station_id, stop_id) AS newest
WHERE newest.late IS NOT NULL;
"""
PARAM_STATION = "Supplier#000000003"


def _mean_newest_delay(station: str) -> str:
    return V.with_(V.SNAPSHOT_MOVEMENTS, V.STATIONS) + f"""
SELECT round(avg(greatest(0, late.m)), 6) AS avg_delay_minutes
FROM (SELECT arg_max({{'m': delay_minutes}}, (l_linenumber, l_shipdate, l_partkey, l_suppkey)) AS late
      FROM snap WHERE is_arrival AND station_id IN (SELECT station_id FROM stations WHERE station_name = '{station}')
      GROUP BY station_id, stop_id)
WHERE late.m IS NOT NULL"""


@register("param_sql", _mean_newest_delay(PARAM_STATION))
def q_param_sql(spark, sf_dir):
    frames = {"movements": roles.snapshot_movements(spark, sf_dir), "stations": roles.stations(spark, sf_dir)}
    return rounded(run_sql(spark, PARAM_SQL_TEXT, {"station_name": PARAM_STATION}, frames))


@register("dim_train", """
SELECT train_id, line_category, train_number, owner_id
FROM (SELECT p_type || '-' || CAST(p_size AS VARCHAR) AS train_id, p_type AS line_category,
             CAST(p_size AS INTEGER) AS train_number, p_brand AS owner_id,
             row_number() OVER (PARTITION BY p_type || '-' || CAST(p_size AS VARCHAR) ORDER BY p_partkey) AS rn
      FROM part)
WHERE rn = 1""")
def q_dim_train(spark, sf_dir):
    return train_dimension(roles.train_stops(spark, sf_dir))


@register("delay_minutes", V.with_(V.UPDATES, V.PLANS) + """
SELECT u.stop_id, u.l_linenumber, u.l_shipdate, u.l_partkey, u.l_suppkey, p.planned_time, u.ct AS actual_time,
       CASE WHEN u.ct IS NOT NULL
            THEN CAST(round(greatest(0, date_diff('second', p.planned_time, u.ct) / 60.0)) AS INTEGER) END
         AS warehouse_delay,
       CASE WHEN p.planned_time IS NOT NULL AND u.ct IS NOT NULL
            THEN round(greatest(0, date_diff('second', p.planned_time, u.ct) / 60.0), 6) ELSE 0.0 END
         AS event_delay
FROM updates u LEFT JOIN plans p ON u.stop_id = p.stop_id""")
def q_delay_minutes(spark, sf_dir):
    u, p = roles.updates(spark, sf_dir), roles.plans(spark, sf_dir)
    j = u.join(p, "stop_id", "left")
    return rounded(j.select("stop_id", *roles.SNAPSHOT_ORDER, "planned_time", F.col("ct").alias("actual_time"),
                            warehouse_delay("planned_time", "ct").alias("warehouse_delay"),
                            event_delay("planned_time", "ct").alias("event_delay")))


def _compact_text(spark, sf_dir):
    e = roles.table(spark, sf_dir, "events")
    f = format_compact_ts("ts")
    raw = (F.when(F.col("event_type") == F.lit("error"), F.concat(f.substr(1, 2), F.lit("13"), f.substr(5, 6)))
           .when(F.col("event_type") == F.lit("signup"), F.lit(""))
           .otherwise(f))
    return e.select("event_id", raw.alias("raw"))


@register("parse_compact_ts", """
SELECT event_id, raw, try_strptime(raw, '%y%m%d%H%M') AS parsed
FROM (SELECT event_id,
             CASE WHEN event_type = 'error' THEN strftime(ts, '%y') || '13' || strftime(ts, '%d%H%M')
                  WHEN event_type = 'signup' THEN ''
                  ELSE strftime(ts, '%y%m%d%H%M') END AS raw
      FROM events)""")
def q_parse_compact_ts(spark, sf_dir):
    t = _compact_text(spark, sf_dir)
    return t.select("event_id", "raw", parse_compact_ts("raw").alias("parsed"))


@register("normalize_name", V.with_(V.RAW_NAMES, V.OVERRIDES) + """
SELECT r.raw_name,
       CASE WHEN nullif(r.raw_name, '') IS NULL THEN NULL
            WHEN o.override_name IS NOT NULL THEN o.override_name
            WHEN starts_with(r.raw_name, 'Berlin ') THEN trim(substr(r.raw_name, 8))
            ELSE r.raw_name END AS normalized
FROM raw_names r LEFT JOIN overrides o ON r.raw_name = o.raw_name""")
def q_normalize_name(spark, sf_dir):
    names = roles.raw_names(spark, sf_dir)
    return normalize_names(names, "raw_name", overrides_frame(spark, roles.ROLE_OVERRIDES)).select("raw_name", "normalized")


# ---------------------------------------------------------------------------
# Step 3: merges, de-duplication, inserts; step 7: constraint checks
# ---------------------------------------------------------------------------

_ORD = "(l_linenumber, l_shipdate, l_partkey, l_suppkey)"


_FOLDED = f"""agg AS (
  SELECT stop_id,
         arg_max(ct, {_ORD}) FILTER (WHERE ct IS NOT NULL) AS actual_time,
         arg_max(cp, {_ORD}) FILTER (WHERE nullif(cp, '') IS NOT NULL) AS actual_platform,
         bool_or(coalesce(cs = 'c' AND clt IS NOT NULL, false)) AS cancelled
  FROM updates
  WHERE ct IS NOT NULL OR nullif(cp, '') IS NOT NULL OR nullif(cs, '') IS NOT NULL
  GROUP BY stop_id)"""


@register("update_merge_coalesce", V.with_(V.UPDATES, V.PLANS, _FOLDED) + """
SELECT p.stop_id, p.planned_time, a.actual_time, a.actual_platform,
       CASE WHEN a.actual_time IS NOT NULL
            THEN CAST(round(greatest(0, date_diff('second', p.planned_time, a.actual_time) / 60.0)) AS INTEGER)
       END AS delay_minutes,
       coalesce(a.cancelled, false) AS is_canceled
FROM plans p LEFT JOIN agg a ON p.stop_id = a.stop_id""")
def q_update_merge_coalesce(spark, sf_dir):
    return M.update_merge_coalesce(roles.plans(spark, sf_dir), roles.updates(spark, sf_dir),
                                   ["stop_id"], roles.SNAPSHOT_ORDER)


@register("update_merge_incremental", V.with_(V.UPDATES, V.PLANS, _FOLDED) + """
SELECT p.stop_id, p.planned_time, a.actual_time, a.actual_platform,
       CASE WHEN a.actual_time IS NOT NULL
            THEN CAST(round(greatest(0, date_diff('second', p.planned_time, a.actual_time) / 60.0)) AS INTEGER)
       END AS delay_minutes,
       coalesce(a.cancelled, false) AS is_canceled
FROM plans p LEFT JOIN agg a ON p.stop_id = a.stop_id""")
def q_update_merge_incremental(spark, sf_dir):
    """Updates in two loads, split within stops by their order, give what one load of all gives."""
    updates, late = roles.updates(spark, sf_dir), F.col("l_linenumber") > 2
    first = M.update_merge_coalesce(roles.plans(spark, sf_dir), updates.filter(~late), ["stop_id"], roles.SNAPSHOT_ORDER)
    return M.update_merge_coalesce(first, updates.filter(late), ["stop_id"], roles.SNAPSHOT_ORDER)


def _load_counts(k: int, cond: str) -> str:
    return f"""SELECT {k} AS load, (SELECT count(*) FROM plans) AS n_rows, count(p.stop_id) AS n_updated, coalesce(sum(n), 0)::BIGINT AS n_updates,
       coalesce(sum(n) FILTER (WHERE p.stop_id IS NULL), 0)::BIGINT AS n_without_row
FROM (SELECT stop_id, count(*) AS n FROM updates
      WHERE (ct IS NOT NULL OR nullif(cp, '') IS NOT NULL OR nullif(cs, '') IS NOT NULL) AND {cond} GROUP BY stop_id)
LEFT JOIN plans p USING (stop_id)"""


@register("load_metrics", V.with_(V.UPDATES, V.PLANS) + _load_counts(1, "l_linenumber <= 2") + "\nUNION ALL\n" + _load_counts(2, "l_linenumber > 2"))
def q_load_metrics(spark, sf_dir):
    """Two loads of all updates into the whole plan, counted while they run."""
    view, updates, late = roles.plans(spark, sf_dir), roles.updates(spark, sf_dir), F.col("l_linenumber") > 2
    counts = []
    for k, load in enumerate((updates.filter(~late), updates.filter(late)), 1):
        view, seen = M.counted_load(view, load, ["stop_id"], roles.SNAPSHOT_ORDER)
        counts.append((k, *[seen[c] for c in M.LOAD_COUNTS]))
    return spark.createDataFrame(counts, "load int, " + ", ".join(f"{c} long" for c in M.LOAD_COUNTS))


def _tagged(spark, sf_dir):
    upd = roles.updates(spark, sf_dir).select(
        "stop_id", F.col("ct").alias("actual_time"), cancelled_flag("cs", "clt").alias("is_canceled"),
        *roles.SNAPSHOT_ORDER)
    plan = roles.plans(spark, sf_dir).select(
        "stop_id", "planned_time", *[F.lit(None).cast(t).alias(c) for c, t in
                                     zip(roles.SNAPSHOT_ORDER, ("int", "timestamp_ntz", "bigint", "bigint"))])
    return M.tag_events(plan, upd, ["stop_id"], roles.SNAPSHOT_ORDER)


@register("event_union", V.with_(V.UPDATES, V.PLANS) + """
SELECT stop_id, 'plan' AS kind, planned_time, CAST(NULL AS TIMESTAMP) AS actual_time, CAST(NULL AS BOOLEAN) AS is_canceled
FROM plans
UNION ALL
SELECT stop_id, 'update', CAST(NULL AS TIMESTAMP), ct, coalesce(cs = 'c' AND clt IS NOT NULL, false) FROM updates""")
def q_event_union(spark, sf_dir):
    return _tagged(spark, sf_dir).select("stop_id", "kind", "planned_time", "actual_time", "is_canceled")


_LAST_UPDATE = f"""u AS (
  SELECT stop_id, arg_max({{'a': ct, 'c': coalesce(cs = 'c' AND clt IS NOT NULL, false)}}, {_ORD}) AS last
  FROM updates GROUP BY stop_id)"""


@register("event_merge_overwrite", V.with_(V.UPDATES, V.PLANS, _LAST_UPDATE) + """
SELECT coalesce(p.stop_id, u.stop_id) AS stop_id, p.planned_time, u.last.a AS actual_time,
       round(CASE WHEN p.planned_time IS NOT NULL AND u.last.a IS NOT NULL
                  THEN greatest(0, date_diff('second', p.planned_time, u.last.a) / 60.0) ELSE 0.0 END, 6) AS delay_minutes,
       coalesce(u.last.c, false) AS is_canceled,
       CAST(coalesce(p.planned_time, u.last.a) AS DATE) AS event_date
FROM plans p FULL OUTER JOIN u ON p.stop_id = u.stop_id""")
def q_event_merge_overwrite(spark, sf_dir):
    return rounded(M.event_merge_overwrite(_tagged(spark, sf_dir), ["stop_id"], roles.SNAPSHOT_ORDER))


@register("fact_dedup", V.with_(V.SNAPSHOT_MOVEMENTS) + """
SELECT stop_id, is_arrival, station_id, delay_minutes, l_linenumber, l_shipdate, l_partkey, l_suppkey, coalesce(delay_minutes > 10, false) AS is_canceled
FROM (SELECT *, row_number() OVER (PARTITION BY stop_id, is_arrival
                 ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey) AS rn FROM snap)
WHERE rn = 1""")
def q_fact_dedup(spark, sf_dir):
    """Rows whose delay is not known do not know whether they are cancelled; the default says they are not."""
    snap = roles.snapshot_movements(spark, sf_dir).withColumn("is_canceled", F.col("delay_minutes") > 10)
    return M.fact_dedup(snap, ["stop_id", "is_arrival"], roles.SNAPSHOT_ORDER)


SPLIT_DATE = "1998-01-01"


def _first_rows(name: str, cond: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY stop_id, is_arrival
                 ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey) AS rn
                 FROM snap WHERE {cond}) WHERE rn = 1)"""


@register("fact_insert_new", V.with_(V.SNAPSHOT_MOVEMENTS, _first_rows("old", f"l_shipdate < TIMESTAMP '{SPLIT_DATE}'"),
                                     _first_rows("new", f"l_shipdate >= TIMESTAMP '{SPLIT_DATE}'")) + """
SELECT stop_id, is_arrival, station_id, delay_minutes, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM old
UNION ALL
SELECT stop_id, is_arrival, station_id, delay_minutes, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM new
WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.stop_id = new.stop_id AND old.is_arrival = new.is_arrival)""")
def q_fact_insert_new(spark, sf_dir):
    snap = roles.snapshot_movements(spark, sf_dir)
    cut = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    keys = ["stop_id", "is_arrival"]
    existing = M.fact_dedup(snap.filter(F.col("l_shipdate") < cut), keys, roles.SNAPSHOT_ORDER)
    batch = snap.filter(F.col("l_shipdate") >= cut)
    return M.fact_insert_new(existing, batch, keys, roles.SNAPSHOT_ORDER)


@register("unique_violations", V.with_(V.SNAPSHOT_MOVEMENTS) + """
SELECT stop_id, is_arrival, count(*) AS n_rows FROM snap GROUP BY stop_id, is_arrival HAVING count(*) > 1""")
def q_unique_violations(spark, sf_dir):
    return C.unique_violations(roles.snapshot_movements(spark, sf_dir), ["stop_id", "is_arrival"])


@register("not_null_violations", V.with_(V.UPDATES) + """
SELECT * FROM (VALUES ('stop_id', (SELECT count(*) FILTER (WHERE stop_id IS NULL) FROM updates)),
                      ('ct', (SELECT count(*) FILTER (WHERE ct IS NULL) FROM updates)),
                      ('cp', (SELECT count(*) FILTER (WHERE cp IS NULL) FROM updates)),
                      ('cs', (SELECT count(*) FILTER (WHERE cs IS NULL) FROM updates))) v(column_name, n_null)""")
def q_not_null_violations(spark, sf_dir):
    return C.not_null_violations(roles.updates(spark, sf_dir), ["stop_id", "ct", "cp", "cs"])


@register("fk_orphans", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def q_fk_orphans(spark, sf_dir):
    return C.fk_orphans(roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
                        roles.table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


@register("fact_fk_orphans", """
WITH fact AS (SELECT l_suppkey AS station_id, l_shipdate AS slot_ts, l_partkey AS part_id FROM lineitem),
trains AS (SELECT DISTINCT p_type || '-' || CAST(p_size AS VARCHAR) AS train_id FROM part),
times AS (SELECT DISTINCT o_orderdate AS slot_ts FROM orders),
named AS (SELECT f.*, p_type || '-' || CAST(p_size AS VARCHAR) AS train_id FROM fact f JOIN part ON p_partkey = part_id)
SELECT 'station_id' AS column_name, count(*) AS n_orphans FROM named
WHERE station_id NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'slot_ts', count(*) FROM named WHERE slot_ts NOT IN (SELECT slot_ts FROM times)
UNION ALL SELECT 'train_id', count(*) FROM named WHERE train_id NOT IN (SELECT train_id FROM trains)""")
def q_fact_fk_orphans(spark, sf_dir):
    """A fact against its three dimensions; the times of orders lack some of those of lines."""
    fact = roles.table(spark, sf_dir, "lineitem").join(
        roles.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("station_id"), F.col("l_shipdate").alias("slot_ts"),
        F.concat("p_type", F.lit("-"), F.col("p_size").cast("string")).alias("train_id"))
    trains = train_dimension(roles.train_stops(spark, sf_dir))
    times = roles.table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("slot_ts")).distinct()
    stations = roles.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("station_id"))
    return C.fact_fk_orphans(fact, {"station_id": stations, "slot_ts": times, "train_id": trains})


@register("star_replace_dimension", """
WITH fact AS (SELECT DISTINCT l_suppkey AS station_id, l_linenumber AS time_id, l_orderkey AS stop_id, l_linestatus = 'F' AS is_arrival
              FROM lineitem)
SELECT station_id, count(*) AS n_kept, count(*) FILTER (WHERE is_arrival) AS n_arrivals FROM fact
WHERE station_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey <> 5) GROUP BY station_id""")
def q_star_replace_dimension(spark, sf_dir):
    """Write stations and fact, replace the stations by those of other nations, and read the rebuilt fact."""
    root = scratch_path(spark, "star")
    stations = roles.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("station_name"), "s_nationkey")
    fact = roles.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station_id"), F.col("l_linenumber").alias("time_id"),
        F.concat(F.lit("T-"), F.col("l_partkey").cast("string")).alias("train_id"), F.col("l_orderkey").alias("stop_id"),
        (F.col("l_linestatus") == F.lit("F")).alias("is_arrival"))
    S.write_star_table(stations, root, "dim_station")
    S.write_star_table(M.fact_dedup(fact, ["station_id", "time_id", "stop_id", "is_arrival"], ["train_id"]), root, S.FACT)
    S.replace_dimension(stations.filter("s_nationkey <> 5"), root, "dim_station")
    return S.read_star_table(spark, root, S.FACT).groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n_kept"), F.count_if(F.col("is_arrival")).alias("n_arrivals"))


_STAR_FACT = """fact AS (
  SELECT station_id, time_id, stop_id, is_arrival, arg_min({'t': train_id, 'p': planned_time}, (train_id, planned_time)) AS r
  FROM (SELECT l_suppkey AS station_id, l_linenumber AS time_id, l_orderkey AS stop_id, l_linestatus = 'F' AS is_arrival,
               'T-' || CAST(l_partkey AS VARCHAR) AS train_id, o_orderdate AS planned_time
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
  GROUP BY station_id, time_id, stop_id, is_arrival)"""


@register("star_update_fact", V.with_(_STAR_FACT, f"""upd AS (
  SELECT l_suppkey AS station_id, l_orderkey AS stop_id, l_linestatus = 'F' AS is_arrival,
         arg_max(l_shipdate, {_ORD}) FILTER (WHERE l_returnflag <> 'N') AS ct,
         arg_max(CAST(l_partkey AS VARCHAR), {_ORD}) FILTER (WHERE l_returnflag <> 'A') AS cp,
         bool_or(l_returnflag = 'R' AND l_linestatus = 'F') AS gone
  FROM lineitem GROUP BY ALL)""") + """
SELECT f.station_id, f.time_id, CAST(f.stop_id AS VARCHAR) AS stop_id, f.is_arrival, r.t AS train_id, r.p AS planned_time, u.ct AS actual_time,
       u.cp AS actual_platform,
       CASE WHEN u.ct IS NOT NULL THEN CAST(round(greatest(0, date_diff('second', r.p, u.ct) / 60.0)) AS INTEGER) END AS delay_minutes,
       coalesce(u.gone, false) AS is_canceled
FROM fact f LEFT JOIN upd u ON u.station_id = f.station_id AND u.stop_id = f.stop_id AND u.is_arrival = f.is_arrival""")
def q_star_update_fact(spark, sf_dir):
    """Store the fact by month, apply its changes in two loads, and read it again."""
    root = scratch_path(spark, "star")
    fact = M.fact_dedup(roles.star_fact(spark, sf_dir), list(S.TABLES[S.FACT][1]), ["train_id", "planned_time"])
    S.write_star_table(fact, root, S.FACT, grain="MONTH")
    changes, late = roles.star_changes(spark, sf_dir), F.col("l_linenumber") > 2
    for load in (changes.filter(~late), changes.filter(late)):
        S.update_fact(spark, root, load, list(roles.SNAPSHOT_ORDER))
    return S.read_star_table(spark, root, S.FACT).select(
        "station_id", "time_id", "stop_id", "is_arrival", "train_id", "planned_time", "actual_time", "actual_platform", "delay_minutes", "is_canceled")


@register("incremental_view", V.with_(V.UPDATES, V.PLANS, _FOLDED) + """
SELECT p.stop_id, p.planned_time, a.actual_time, a.actual_platform,
       CASE WHEN a.actual_time IS NOT NULL
            THEN CAST(round(greatest(0, date_diff('second', p.planned_time, a.actual_time) / 60.0)) AS INTEGER)
       END AS delay_minutes,
       coalesce(a.cancelled, false) AS is_canceled
FROM plans p LEFT JOIN agg a ON p.stop_id = a.stop_id""")
def q_incremental_view(spark, sf_dir):
    """All updates merged into a stored fold in three batches, of which the last is late: it sorts before the others."""
    root, updates = scratch_path(spark, "fold"), roles.updates(spark, sf_dir)
    keys, n = ["stop_id"], F.col("l_linenumber")
    for k, batch in enumerate((updates.filter((n > 1) & (n <= 4)), updates.filter(n > 4), updates.filter(n <= 1))):
        I.merge_into_fold(batch, root, keys, roles.SNAPSHOT_ORDER, batch=("updates", k))
    return I.merged_view(roles.plans(spark, sf_dir), root, updates, keys, roles.SNAPSHOT_ORDER)


# ---------------------------------------------------------------------------
# Step 4: names
# ---------------------------------------------------------------------------

_TRI_A = V.TRIGRAMS.format(c="search_name")
_TRI_B = V.TRIGRAMS.format(c="station_name")
_PROBES = "probes AS (SELECT DISTINCT " + V.MESSY.format(c="p_name") + " AS search_name FROM part)"
_FUZZY = f"""fz_pairs AS (
  SELECT p.search_name, s.station_id, s.station_name, {_TRI_A} AS a, {_TRI_B} AS b
  FROM __PROBE_REL__ p, name_stations s),
fz_scored AS (
  SELECT *, len(list_intersect(a, b)) AS sh, len(a) + len(b) - len(list_intersect(a, b)) AS un FROM fz_pairs),
fz_best AS (
  SELECT search_name, station_id, station_name, sh / un AS similarity FROM (
    SELECT *, row_number() OVER (PARTITION BY search_name ORDER BY sh / un DESC, station_name, station_id) AS rn
    FROM fz_scored WHERE sh * 5 > un * 2) WHERE rn = 1)"""


@register("trigram_similarity", f"""
WITH pairs AS (SELECT DISTINCT {V.MESSY.format(c="p_name")} AS search_name, p_name AS station_name FROM part),
g AS (SELECT search_name, station_name, {_TRI_A} AS a, {_TRI_B} AS b FROM pairs)
SELECT search_name, station_name, CAST(len(list_intersect(a, b)) AS INTEGER) AS n_shared,
       CAST(len(a) + len(b) - len(list_intersect(a, b)) AS INTEGER) AS n_union,
       round(CASE WHEN len(a) + len(b) - len(list_intersect(a, b)) > 0
                  THEN len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) ELSE 0 END, 6)
         AS similarity
FROM g""")
def q_trigram_similarity(spark, sf_dir):
    return rounded(R.pair_similarity(roles.abbreviated_pairs(spark, sf_dir), "search_name", "station_name"))


@register("fuzzy_name_join", V.with_(V.NAME_STATIONS, _PROBES, _FUZZY.replace("__PROBE_REL__", "probes")) + """
SELECT search_name, station_id, station_name, round(similarity, 6) AS similarity FROM fz_best""")
def q_fuzzy_name_join(spark, sf_dir):
    probes = roles.abbreviated_pairs(spark, sf_dir).select("search_name")
    return rounded(R.fuzzy_best_match(probes, "search_name", roles.name_stations(spark, sf_dir)))


_RESOLVE = [V.RAW_NAMES, V.OVERRIDES, V.NAME_STATIONS, """idx AS (
  SELECT station_name, count(*) AS n_st, min(station_id) AS idx_id FROM name_stations GROUP BY station_name)""",
            """base AS (
  SELECT r.raw_name, o.override_name,
         nullif(CASE WHEN starts_with(r.raw_name, 'Berlin ') THEN trim(substr(r.raw_name, 8)) ELSE r.raw_name END, '')
           AS search_name
  FROM raw_names r LEFT JOIN overrides o ON r.raw_name = o.raw_name)""",
            """looked AS (
  SELECT b.*, i.n_st, i.idx_id FROM base b LEFT JOIN idx i ON i.station_name = coalesce(b.override_name, b.search_name))""",
            "need AS (SELECT DISTINCT search_name FROM looked WHERE override_name IS NULL AND n_st IS NULL)",
            _FUZZY.replace("__PROBE_REL__", "need"),
            """resolved AS (
  SELECT l.raw_name, l.override_name, l.n_st, l.idx_id, f.station_id AS fz_id
  FROM looked l LEFT JOIN fz_best f ON l.override_name IS NULL AND l.search_name = f.search_name)"""]


@register("station_resolve", V.with_(*_RESOLVE) + """
SELECT raw_name,
       CASE WHEN n_st = 1 THEN idx_id ELSE fz_id END AS station_id,
       CASE WHEN override_name IS NOT NULL THEN 'override' WHEN n_st = 1 THEN 'exact' ELSE 'fuzzy' END AS method
FROM resolved
WHERE n_st = 1 OR (override_name IS NULL AND n_st IS NULL AND fz_id IS NOT NULL)""")
def q_station_resolve(spark, sf_dir):
    r = R.resolve_names(roles.raw_names(spark, sf_dir), roles.name_stations(spark, sf_dir),
                        overrides_frame(spark, roles.ROLE_OVERRIDES))
    return r.filter(F.col("station_id").isNotNull()).select("raw_name", "station_id", "method")


@register("station_unresolved", V.with_(*_RESOLVE) + """
SELECT raw_name,
       CASE WHEN override_name IS NOT NULL AND n_st IS NULL THEN 'override target missing'
            WHEN override_name IS NOT NULL THEN 'ambiguous override target'
            WHEN n_st > 1 THEN 'ambiguous name' ELSE 'no match' END AS reason
FROM resolved
WHERE NOT coalesce(n_st = 1 OR (override_name IS NULL AND n_st IS NULL AND fz_id IS NOT NULL), false)""")
def q_station_unresolved(spark, sf_dir):
    r = R.resolve_names(roles.raw_names(spark, sf_dir), roles.name_stations(spark, sf_dir),
                        overrides_frame(spark, roles.ROLE_OVERRIDES))
    return r.filter(F.col("station_id").isNull()).select("raw_name", "reason")


# ---------------------------------------------------------------------------
# Step 5: nested sources and the partitioned sink
# ---------------------------------------------------------------------------

_XML_EV = """xev AS (
  SELECT *, CASE WHEN event_type = 'purchase' THEN 'Bus' ELSE event_type END AS cat,
         CAST(CAST(floor(value) AS INTEGER) % 12 AS VARCHAR) AS platform,
         date_trunc('minute', ts) AS pt,
         CASE WHEN value >= 30 THEN date_trunc('minute', ts) + to_minutes(CAST(floor(value) AS BIGINT)) END AS ct
  FROM events),
xm AS (
  SELECT xev.*, x.is_arrival FROM xev JOIN (VALUES (true), (false)) x(is_arrival)
    ON (x.is_arrival AND event_type IN ('click', 'signup', 'purchase'))
    OR (NOT x.is_arrival AND event_type IN ('view', 'signup', 'error')))"""


@register("xml_plan_rows", V.with_(_XML_EV) + """
SELECT CAST(user_id AS VARCHAR) AS station_name, CAST(event_id AS VARCHAR) AS stop_id,
       cat || '-' || CAST(user_id AS VARCHAR) AS train_id, is_arrival, platform AS planned_platform,
       pt AS planned_time, (event_type = 'error' AND NOT is_arrival) AS is_canceled
FROM xm WHERE event_type <> 'signup' AND cat <> 'Bus'""")
def q_xml_plan_rows(spark, sf_dir):
    rows = X.warehouse_plan_rows(roles.event_documents(spark, sf_dir))
    return rows.select("station_name", "stop_id", "train_id", "is_arrival", "planned_platform",
                       "planned_time", "is_canceled")


@register("xml_change_rows", V.with_(_XML_EV) + """
SELECT CAST(user_id AS VARCHAR) AS station_name, CAST(event_id AS VARCHAR) AS stop_id, is_arrival, ct,
       CASE WHEN event_type = 'click' THEN platform END AS cp,
       coalesce(event_type = 'error' AND value > 50, false) AS cancelled
FROM xm WHERE ct IS NOT NULL OR event_type IN ('click', 'error')""")
def q_xml_change_rows(spark, sf_dir):
    rows = X.warehouse_change_rows(roles.event_documents(spark, sf_dir, change=True))
    return rows.select("station_name", "stop_id", "is_arrival", "ct", "cp", "cancelled")


_SCAN_SPLIT = "2401150000"  # folders before it are there in a first scan, the rest in a second


def _scanned(spark, root, suffix, validate):
    first = X.scan_snapshot_files(spark, root, suffix, validate, until=_SCAN_SPLIT)
    return first.unionByName(X.scan_snapshot_files(spark, root, suffix, validate, since=_SCAN_SPLIT))


@register("xml_scan_plan", V.with_(_XML_EV) + f"""
SELECT 'g' || CAST(user_id % {roles.FILE_STATIONS} AS VARCHAR) AS station_name, CAST(event_id AS VARCHAR) AS stop_id,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS snapshot_ts, cat || '-' || CAST(user_id AS VARCHAR) AS train_id, is_arrival,
       platform AS planned_platform, pt AS planned_time, (event_type = 'error' AND NOT is_arrival) AS is_canceled
FROM xm WHERE event_type <> 'signup' AND cat <> 'Bus'""")
def q_xml_scan_plan(spark, sf_dir):
    """Documents written as files, then read from their folders in two scans."""
    docs = _scanned(spark, roles.snapshot_file_root(spark, sf_dir), PLAN_FILE_SUFFIX, True)
    return X.warehouse_plan_rows(docs).select("station_name", "stop_id", "snapshot_ts", "train_id", "is_arrival", "planned_platform",
                                              "planned_time", "is_canceled")


@register("xml_scan_change", V.with_(_XML_EV) + f"""
SELECT 'g' || CAST(user_id % {roles.FILE_STATIONS} AS VARCHAR) AS station_name, CAST(event_id AS VARCHAR) AS stop_id,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS snapshot_ts, is_arrival, ct, CASE WHEN event_type = 'click' THEN platform END AS cp,
       coalesce(event_type = 'error' AND value > 50, false) AS cancelled
FROM xm WHERE ct IS NOT NULL OR event_type IN ('click', 'error')""")
def q_xml_scan_change(spark, sf_dir):
    """The same of change documents."""
    docs = _scanned(spark, roles.snapshot_file_root(spark, sf_dir, change=True), CHANGE_FILE_SUFFIX, False)
    return X.warehouse_change_rows(docs).select("station_name", "stop_id", "snapshot_ts", "is_arrival", "ct", "cp", "cancelled")


@register("xml_malformed_skipped", f"""
WITH d AS (SELECT user_id, floor(event_id / {roles.DOC_GROUP}) AS grp, count(*) AS n,
                  arg_min(event_type, event_id) AS first_type FROM events GROUP BY ALL)
SELECT count(*) AS n_documents, count(*) FILTER (WHERE first_type = 'error') AS n_rejected,
       CAST(coalesce(sum(n) FILTER (WHERE first_type <> 'error'), 0) AS BIGINT) AS n_stops
FROM d""")
def q_xml_malformed_skipped(spark, sf_dir):
    return X.malformed_report(roles.event_documents(spark, sf_dir, corrupt=True))


@register("parquet_partition_read", V.with_(_XML_EV) + """
SELECT CAST(user_id AS VARCHAR) AS station_name, CAST(event_id AS VARCHAR) AS stop_id,
       CASE WHEN event_type <> 'signup' THEN cat || '-' || CAST(user_id AS VARCHAR) END AS train_id,
       is_arrival, pt AS planned_time, ct AS actual_time,
       round(CASE WHEN ct IS NOT NULL THEN greatest(0, date_diff('second', pt, ct) / 60.0) ELSE 0.0 END, 6)
         AS delay_minutes,
       coalesce(event_type = 'error' AND value > 50, false) AS is_canceled, CAST(pt AS DATE) AS event_date
FROM xm WHERE cat <> 'Bus'""")
def q_parquet_partition_read(spark, sf_dir):
    docs = roles.event_documents(spark, sf_dir).unionByName(roles.event_documents(spark, sf_dir, change=True))
    path = P.write_movement_events(W.movement_events(docs, overrides_frame(spark)))
    return rounded(P.read_movement_events(spark, path))


@register("json_station_flatten", """
SELECT s_suppkey AS station_id, s_name AS station_name,
       CASE WHEN s_nationkey % 5 = 1 THEN NULL ELSE round(CAST(s_nationkey AS DOUBLE), 6) END AS latitude,
       round(s_acctbal / 1000.0, 6) AS longitude,
       'de:11000:' || CAST(s_suppkey AS VARCHAR) AS ifopt_id, CAST(s_nationkey % 7 AS INTEGER) AS category,
       CAST(s_nationkey % 3 + 1 AS INTEGER) AS price_category,
       lpad(CAST(10000 + s_suppkey % 90000 AS VARCHAR), 5, '0') AS zipcode,
       CASE WHEN s_acctbal < 0 THEN 'no' WHEN s_acctbal < 5000 THEN 'partial' ELSE 'yes' END AS has_stepless_access,
       CASE WHEN s_nationkey % 4 = 0 THEN false WHEN s_nationkey % 4 = 1 THEN true
            WHEN s_nationkey % 4 = 2 THEN s_acctbal > 2500 ELSE false END AS has_wifi
FROM supplier WHERE s_suppkey <> 0 AND s_nationkey % 5 <> 3""")
def q_json_station_flatten(spark, sf_dir):
    return rounded(J.flatten_stations(J.parse_station_documents(roles.station_json(spark, sf_dir))))


# ---------------------------------------------------------------------------
# Step 6: graph
# ---------------------------------------------------------------------------

W0, W1 = roles.ARRIVAL_WINDOW


def _values(rows, cols):
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) v({', '.join(cols)})"


_GNAMES = "gnames AS (SELECT station_name, max(station_id) AS station_id FROM gstations GROUP BY station_name)"
_HOP_REQ = ("hreq AS (SELECT v.*, o.station_id AS origin_id, d.station_id AS destination_id FROM "
            + _values(roles.HOP_REQUESTS, ["request_id", "origin_name", "destination_name"])
            + " LEFT JOIN gnames o ON o.station_name = v.origin_name"
            + " LEFT JOIN gnames d ON d.station_name = v.destination_name)")
_ROUTE_REQ = ("rreq AS (SELECT v.*, o.station_id AS origin_id, d.station_id AS destination_id, "
              "try_strptime(v.depart_text, '%Y-%m-%d %H:%M') AS depart_ts FROM "
              + _values(roles.ROUTE_REQUESTS, ["request_id", "origin_name", "destination_name", "depart_text"])
              + " LEFT JOIN gnames o ON o.station_name = v.origin_name"
              + " LEFT JOIN gnames d ON d.station_name = v.destination_name)")
_BFS = """adj AS (SELECT DISTINCT u, v FROM edges),
paths(origin, node, lvl, path) USING KEY (origin, node) AS (
  SELECT o.station_id, o.station_id, 0, [n.station_name]
  FROM __ORIGINS__ o JOIN gnames n ON n.station_id = o.station_id
  UNION
  SELECT p.origin, a.v, min(p.lvl) + 1, min(list_append(p.path, n.station_name))
  FROM paths p JOIN adj a ON a.u = p.node JOIN gnames n ON n.station_id = a.v
  WHERE NOT EXISTS (SELECT 1 FROM recurring.paths x WHERE x.origin = p.origin AND x.node = a.v)
  GROUP BY p.origin, a.v)"""
_LABELS = """lab(request_id, origin_id, node, t) AS (
  SELECT request_id, origin_id, origin_id, depart_ts FROM __STARTS__
  UNION
  SELECT l.request_id, l.origin_id, e.v, e.arr FROM lab l JOIN edges e ON e.u = l.node
    AND e.dep >= CASE WHEN l.node = l.origin_id THEN l.t ELSE l.t + INTERVAL 2 MINUTE END),
best AS (SELECT request_id, node, min(t) AS arrival FROM lab GROUP BY request_id, node)"""


def _rwith(*ctes):
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _edges(spark, sf_dir):
    return G.build_edges(roles.graph_movements(spark, sf_dir))


@register("graph_edges", V.with_(V.GRAPH_MOVEMENTS, V.edges_cte(W0, W1)) + "SELECT train_id, u, v, dep, arr FROM edges")
def q_graph_edges(spark, sf_dir):
    return G.build_edges(roles.graph_movements(spark, sf_dir), W0, W1)


@register("graph_edges_fact", """
WITH now AS (
  SELECT l_orderkey AS stop_id, l_linestatus = 'F' AS is_arrival,
         arg_max({'train_id': l_partkey, 'station_id': l_suppkey, 't': l_shipdate},
                 (l_linenumber, l_shipdate, l_partkey, l_suppkey)) AS r
  FROM lineitem GROUP BY l_orderkey, l_linestatus = 'F'),
seq AS (
  SELECT r.train_id AS train_id, r.station_id AS u, is_arrival, r.t AS dep, lead(r.station_id) OVER w AS v,
         lead(is_arrival) OVER w AS then_arrival, lead(r.t) OVER w AS arr
  FROM now WINDOW w AS (PARTITION BY r.train_id ORDER BY r.t, NOT is_arrival, stop_id))
SELECT train_id, u, v, dep, arr FROM seq WHERE NOT is_arrival AND then_arrival AND u <> v""")
def q_graph_edges_fact(spark, sf_dir):
    return G.build_edges(G.fact_movements(roles.snapshot_fact(spark, sf_dir), ["stop_id", "is_arrival"], list(roles.SNAPSHOT_ORDER)))


@register("graph_adjacency", V.with_(V.GRAPH_MOVEMENTS, V.edges_cte()) + "SELECT DISTINCT u, v FROM edges")
def q_graph_adjacency(spark, sf_dir):
    return G.adjacency(_edges(spark, sf_dir))


@register("graph_time_range", V.with_(V.GRAPH_MOVEMENTS, V.edges_cte()) + f"""
SELECT min(planned_time) AS min_time, max(planned_time) AS max_time, count(*) AS n_movements,
       (SELECT count(*) FROM edges) AS n_edges
FROM gm""")
def q_graph_time_range(spark, sf_dir):
    return G.time_range(roles.graph_movements(spark, sf_dir), edges=_edges(spark, sf_dir))


_CUST_REQ = """creq AS (
  SELECT c_custkey AS request_id, format('st{:03d}', c_custkey % 100) AS origin_name,
         format('st{:03d}', (c_custkey * 7 + c_nationkey) % 100) AS destination_name,
         (SELECT min(planned_time) FROM gm) + to_hours(CAST(c_nationkey AS BIGINT)) AS depart_ts
  FROM customer),
cres AS (SELECT c.*, o.station_id AS origin_id, d.station_id AS destination_id FROM creq c
  LEFT JOIN gnames o ON o.station_name = c.origin_name LEFT JOIN gnames d ON d.station_name = c.destination_name)"""


@register("shortest_hops_all", _rwith(
    V.GRAPH_MOVEMENTS, V.GRAPH_STATIONS, V.edges_cte(), _GNAMES, _CUST_REQ,
    "corig AS (SELECT DISTINCT origin_id AS station_id FROM cres WHERE origin_id IS NOT NULL AND destination_id IS NOT NULL)",
    _BFS.replace("__ORIGINS__", "corig")) + """
SELECT r.request_id, r.origin_name, r.destination_name, p.lvl AS hops, array_to_string(p.path, ' -> ') AS path,
       CASE WHEN r.origin_id IS NULL OR r.destination_id IS NULL THEN 'Station not found'
            WHEN p.lvl IS NULL THEN 'No connection found' ELSE 'ok' END AS status
FROM cres r LEFT JOIN paths p ON p.origin = r.origin_id AND p.node = r.destination_id""")
def q_shortest_hops_all(spark, sf_dir):
    """One request for every customer."""
    return G.shortest_hops(roles.customer_requests(spark, sf_dir), G.adjacency(_edges(spark, sf_dir)),
                           roles.graph_stations(spark, sf_dir))


_HOPS_ORIGINS = "horig AS (SELECT DISTINCT origin_id AS station_id FROM hreq WHERE origin_id IS NOT NULL AND destination_id IS NOT NULL)"


@register("shortest_hops", _rwith(V.GRAPH_MOVEMENTS, V.GRAPH_STATIONS, V.edges_cte(), _GNAMES, _HOP_REQ,
                                  _HOPS_ORIGINS, _BFS.replace("__ORIGINS__", "horig")) + f"""
SELECT r.request_id, r.origin_name, r.destination_name, p.lvl AS hops, array_to_string(p.path, ' -> ') AS path,
       CASE WHEN r.origin_id IS NULL OR r.destination_id IS NULL THEN 'Station not found'
            WHEN p.lvl IS NULL THEN 'No connection found' ELSE 'ok' END AS status
FROM hreq r LEFT JOIN paths p ON p.origin = r.origin_id AND p.node = r.destination_id""")
def q_shortest_hops(spark, sf_dir):
    return G.shortest_hops(roles.hop_requests(spark), G.adjacency(_edges(spark, sf_dir)),
                           roles.graph_stations(spark, sf_dir))


_ROUTE_STARTS = ("rstart AS (SELECT request_id, origin_id, depart_ts FROM rreq "
                 "WHERE origin_id IS NOT NULL AND destination_id IS NOT NULL AND depart_ts IS NOT NULL)")


@register("earliest_arrival", _rwith(V.GRAPH_MOVEMENTS, V.GRAPH_STATIONS, V.edges_cte(), _GNAMES, _ROUTE_REQ,
                                     _ROUTE_STARTS, _LABELS.replace("__STARTS__", "rstart")) + """
SELECT r.request_id, r.origin_name, r.destination_name, r.depart_ts, b.arrival,
       CASE WHEN r.origin_id IS NULL OR r.destination_id IS NULL THEN 'Station not found'
            WHEN b.arrival IS NULL THEN 'No connection found' ELSE 'ok' END AS status
FROM rreq r LEFT JOIN best b ON b.request_id = r.request_id AND b.node = r.destination_id""")
def q_earliest_arrival(spark, sf_dir):
    return G.earliest_arrival(roles.route_requests(spark), _edges(spark, sf_dir), roles.graph_stations(spark, sf_dir))


@register("earliest_arrival_all", _rwith(
    V.GRAPH_MOVEMENTS, V.GRAPH_STATIONS, V.edges_cte(), _GNAMES, _CUST_REQ, """lab(origin_id, depart_ts, node, t) USING KEY (origin_id, depart_ts, node) AS (
  SELECT DISTINCT origin_id, depart_ts, origin_id, depart_ts FROM cres WHERE origin_id IS NOT NULL AND destination_id IS NOT NULL
  UNION
  SELECT l.origin_id, l.depart_ts, e.v, min(e.arr) FROM lab l JOIN edges e ON e.u = l.node
    AND e.dep >= CASE WHEN l.node = l.origin_id THEN l.t ELSE l.t + INTERVAL 2 MINUTE END
  WHERE NOT EXISTS (SELECT 1 FROM recurring.lab x WHERE x.origin_id = l.origin_id AND x.depart_ts = l.depart_ts
                    AND x.node = e.v AND x.t <= e.arr)
  GROUP BY l.origin_id, l.depart_ts, e.v)""") + """
SELECT r.request_id, r.origin_name, r.destination_name, r.depart_ts, b.t AS arrival,
       CASE WHEN r.origin_id IS NULL OR r.destination_id IS NULL THEN 'Station not found'
            WHEN b.t IS NULL THEN 'No connection found' ELSE 'ok' END AS status
FROM cres r LEFT JOIN lab b ON b.origin_id = r.origin_id AND b.depart_ts = r.depart_ts AND b.node = r.destination_id""")
def q_earliest_arrival_all(spark, sf_dir):
    """One request for every customer."""
    return G.earliest_arrival(roles.customer_requests(spark, sf_dir), _edges(spark, sf_dir), roles.graph_stations(spark, sf_dir))


@register("earliest_arrival_itinerary", _rwith(
    V.GRAPH_MOVEMENTS, V.GRAPH_STATIONS, V.edges_cte(), _GNAMES, _ROUTE_REQ, _ROUTE_STARTS,
    _LABELS.replace("__STARTS__", "rstart"), """walk(request_id, origin_id, node, label, final_arrival, legs) AS (
  SELECT r.request_id, r.origin_id, r.destination_id, b.arrival, b.arrival,
         CAST([] AS STRUCT(station_id INTEGER, dep TIMESTAMP, train_id BIGINT)[])
  FROM rreq r JOIN best b ON b.request_id = r.request_id AND b.node = r.destination_id
  UNION ALL
  SELECT request_id, origin_id, pick.u, pick.lab_u, final_arrival,
         list_prepend({'station_id': pick.u, 'dep': pick.dep, 'train_id': pick.train_id}, legs)
  FROM (SELECT w.request_id, w.origin_id, w.final_arrival, w.legs,
               arg_max({'u': e.u, 'dep': e.dep, 'train_id': e.train_id, 'lab_u': bu.arrival},
                       (e.dep, -e.u, -e.train_id)) AS pick
        FROM walk w JOIN edges e ON e.v = w.node AND e.arr = w.label
        JOIN best bu ON bu.request_id = w.request_id AND bu.node = e.u
        WHERE w.node <> w.origin_id
          AND e.dep >= CASE WHEN e.u = w.origin_id THEN bu.arrival ELSE bu.arrival + INTERVAL 2 MINUTE END
        GROUP BY w.request_id, w.origin_id, w.final_arrival, w.legs))""") + """
SELECT w.request_id, w.final_arrival AS arrival,
       concat_ws(' -> ', nullif(array_to_string(list_transform(w.legs, lambda x:
           format('st{:03d}', x.station_id) || ' ' || strftime(x.dep, '%H:%M') || ' [' || CAST(x.train_id AS VARCHAR) || ']'),
           ' -> '), ''),
         d.station_name || ' arr ' || strftime(w.final_arrival, '%H:%M')) AS itinerary
FROM walk w JOIN rreq r ON r.request_id = w.request_id JOIN gnames d ON d.station_id = r.destination_id
WHERE w.node = w.origin_id""")
def q_earliest_arrival_itinerary(spark, sf_dir):
    return G.itineraries(roles.route_requests(spark), _edges(spark, sf_dir), roles.graph_stations(spark, sf_dir))


@register("route_status", _rwith(V.GRAPH_MOVEMENTS, V.GRAPH_STATIONS, V.edges_cte(), _GNAMES, _ROUTE_REQ,
                                 _ROUTE_STARTS, _LABELS.replace("__STARTS__", "rstart"),
                                 f"""rng AS (SELECT min(planned_time) AS lo, max(planned_time) AS hi FROM gm)""") + """
SELECT r.request_id,
       CASE WHEN r.origin_id IS NULL OR r.destination_id IS NULL THEN 'Station not found'
            WHEN b.arrival IS NULL THEN 'No connection found' ELSE 'ok' END AS status,
       coalesce(r.depart_ts < rng.lo OR r.depart_ts > rng.hi, false) AS out_of_range
FROM rreq r LEFT JOIN best b ON b.request_id = r.request_id AND b.node = r.destination_id, rng""")
def q_route_status(spark, sf_dir):
    moves = roles.graph_movements(spark, sf_dir)
    res = G.earliest_arrival(roles.route_requests(spark), _edges(spark, sf_dir), roles.graph_stations(spark, sf_dir))
    return G.route_status(res, G.time_range(moves))


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
