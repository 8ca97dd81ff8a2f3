"""DuckDB SQL for the role projections (the SQL twins of ``roles.py``).

Each constant is one CTE body; queries prefix the ones they need.
"""

STATIONS = """stations AS (
  SELECT s_suppkey AS station_id, s_name AS station_name,
         CAST(s_nationkey AS DOUBLE) AS latitude, s_acctbal / 1000.0 AS longitude
  FROM supplier)"""

POINTS = """points AS (
  SELECT c_custkey AS point_id, CAST(c_nationkey AS DOUBLE) AS latitude, c_acctbal / 1000.0 AS longitude
  FROM customer)"""

MOVEMENT_EVENT = """movement_event AS (
  SELECT CAST(user_id AS VARCHAR) AS station_name, CAST(event_id AS VARCHAR) AS stop_id,
         event_type || '-' || CAST(user_id AS VARCHAR) AS train_id,
         event_type <> 'view' AS is_arrival, ts AS planned_time,
         CAST(NULL AS TIMESTAMP) AS actual_time,
         greatest(CAST(0 AS DOUBLE), value - 30.0) AS delay_minutes,
         event_type = 'error' AS is_canceled, CAST(ts AS DATE) AS event_date
  FROM events)"""

SNAPSHOT_MOVEMENTS = """snap AS (
  SELECT l_suppkey AS station_id, l_orderkey AS stop_id, l_linestatus = 'F' AS is_arrival,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity AS INTEGER) - 25 END AS delay_minutes,
         l_linenumber, l_shipdate, l_partkey, l_suppkey
  FROM lineitem)"""

PLANS = """plans AS (SELECT o_orderkey AS stop_id, o_orderdate AS planned_time FROM orders)"""

UPDATES = """updates AS (
  SELECT l_orderkey AS stop_id,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_shipdate END AS ct,
         CASE WHEN l_returnflag = 'A' THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS cp,
         CASE WHEN l_returnflag = 'R' THEN 'c' END AS cs,
         CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS clt,
         l_linenumber, l_shipdate, l_partkey, l_suppkey
  FROM lineitem)"""

TIME_DIM = """dim_time AS (
  SELECT CAST(row_number() OVER (ORDER BY slot_ts) AS INTEGER) AS time_id, slot_ts,
         CAST(slot_ts AS DATE) AS date, CAST(year(slot_ts) AS INTEGER) AS year,
         CAST(month(slot_ts) AS INTEGER) AS month, CAST(day(slot_ts) AS INTEGER) AS day,
         dayname(slot_ts) AS day_of_week, CAST(hour(slot_ts) AS INTEGER) AS hour,
         CAST(minute(slot_ts) AS INTEGER) AS minute,
         hour(slot_ts) IN (7, 8, 17, 18) AS is_peak_hour, isodow(slot_ts) >= 6 AS is_weekend
  FROM (SELECT unnest(generate_series(b.s, b.e, INTERVAL 15 MINUTE)) AS slot_ts
        FROM (SELECT date_trunc('day', min(ts)) AS s, max(ts) AS e FROM events) b))"""

SLOTTED_EVENTS = """slotted AS (
  SELECT event_id, user_id AS station_id, event_type <> 'view' AS is_arrival,
         event_type = 'error' AS is_canceled,
         date_trunc('hour', ts) + to_minutes(CAST(floor(minute(ts) / 15) * 15 AS BIGINT)) AS slot_ts
  FROM events)"""

NAME_STATIONS = """name_stations AS (
  SELECT p_name AS station_name, min(p_partkey) AS station_id FROM part GROUP BY p_name)"""

# Abbreviation: first three letters of word 1, ". ", word 2.
MESSY = "(substr(split_part({c}, ' ', 1), 1, 3) || '. ' || split_part({c}, ' ', 2))"

RAW_NAMES = """raw_names AS (
  SELECT DISTINCT raw_name FROM (
    SELECT unnest([n, 'Berlin ' || n, {m}, 'Berlin ' || {m}]) AS raw_name
    FROM (SELECT DISTINCT p_name AS n FROM part)
    UNION ALL SELECT * FROM (VALUES ('Berlin Hbf'), ('Berlin Yorck (S1)'), ('Berlin Yorck (S2)'), ('Zzyzx Qwv')) v(raw_name)))
""".replace("{m}", MESSY.format(c="n"))

OVERRIDES = """overrides AS (
  SELECT * FROM (VALUES ('Berlin Hbf', 'red widget'), ('Berlin Yorck (S1)', 'hot rod'),
                        ('Berlin Yorck (S2)', 'no such station')) v(raw_name, override_name))"""

# Trigram set of a text expression, as a DuckDB list.
TRIGRAMS = """list_distinct(flatten(list_transform(
    list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''),
    lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"""

GRAPH_MOVEMENTS = """gm AS (
  SELECT user_id AS train_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS station_id,
         event_type NOT IN ('view', 'click', 'signup') AS is_arrival, ts AS planned_time, event_id AS tie
  FROM events)"""

GRAPH_STATIONS = """gstations AS (
  SELECT DISTINCT station_id, format('st{:03d}', station_id) AS station_name FROM gm)"""


def edges_cte(start: str | None = None, end: str | None = None, name: str = "edges") -> str:
    window = f"WHERE planned_time >= TIMESTAMP '{start}' AND planned_time < TIMESTAMP '{end}'" if start else ""
    return f"""{name} AS (
  SELECT train_id, station_id AS u, nxt_station AS v, planned_time AS dep, nxt_time AS arr
  FROM (SELECT *, lead(station_id) OVER w AS nxt_station, lead(is_arrival) OVER w AS nxt_arrival,
               lead(planned_time) OVER w AS nxt_time
        FROM gm {window}
        WINDOW w AS (PARTITION BY train_id ORDER BY planned_time, tie))
  WHERE NOT is_arrival AND nxt_arrival AND station_id <> nxt_station)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
