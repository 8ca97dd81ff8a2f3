"""Projection of the driver's test tables onto the transit model's roles.

Every role is a lazy DataFrame over a whole table (plus, for names and route
requests, a handful of literal rows that exercise edge cases); nothing here
subsets rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions.timefmt import floor_to_slot, start_of_day
from railyard.sources.timedim import time_dimension

# Overrides used with the part-name roles: two that hit a canonical name and
# one whose target does not exist (stays unresolved, no fallback).
ROLE_OVERRIDES = {
    "Berlin Hbf": "red widget",
    "Berlin Yorck (S1)": "hot rod",
    "Berlin Yorck (S2)": "no such station",
}
ROLE_UNMATCHED = "Zzyzx Qwv"

# A window of planned time, for the query whose feature it is; the searches take the whole table.
ARRIVAL_WINDOW = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- stations and points -------------------------------------------------------

def stations(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("station_name"),
        F.col("s_nationkey").cast("double").alias("latitude"),
        (F.col("s_acctbal") / F.lit(1000.0)).alias("longitude"))


def points(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("point_id"),
        F.col("c_nationkey").cast("double").alias("latitude"),
        (F.col("c_acctbal") / F.lit(1000.0)).alias("longitude"))


# --- movement roles -------------------------------------------------------------

SNAPSHOT_ORDER = ("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")


def snapshot_movements(spark, sf_dir) -> DataFrame:
    """Fact rows with snapshots: one stop event may appear in several snapshots."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("station_id"),
        F.col("l_orderkey").alias("stop_id"),
        (F.col("l_linestatus") == F.lit("F")).alias("is_arrival"),
        F.when(F.col("l_returnflag") == F.lit("N"), F.lit(None).cast("int"))
         .otherwise(F.col("l_quantity").cast("int") - F.lit(25)).alias("delay_minutes"),
        *[F.col(c) for c in SNAPSHOT_ORDER])


def plans(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("stop_id"), F.col("o_orderdate").alias("planned_time"))


def updates(spark, sf_dir) -> DataFrame:
    """Change events: ct / cp / cs / clt attributes in snapshot order."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("stop_id"),
        F.when(F.col("l_returnflag") == F.lit("N"), F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("l_shipdate")).alias("ct"),
        F.when(F.col("l_returnflag") == F.lit("A"), F.lit(None).cast("string"))
         .otherwise(F.col("l_suppkey").cast("string")).alias("cp"),
        F.when(F.col("l_returnflag") == F.lit("R"), F.lit("c")).alias("cs"),
        F.when(F.col("l_linestatus") == F.lit("F"), F.col("l_shipdate")).alias("clt"),
        *[F.col(c) for c in SNAPSHOT_ORDER])


def movement_events(spark, sf_dir) -> DataFrame:
    """Rows of the partitioned movement Parquet (Spark path)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("station_name"),
        F.col("event_id").cast("string").alias("stop_id"),
        F.concat(F.col("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias("train_id"),
        (F.col("event_type") != F.lit("view")).alias("is_arrival"),
        F.col("ts").alias("planned_time"),
        F.lit(None).cast("timestamp_ntz").alias("actual_time"),
        F.greatest(F.lit(0.0), F.col("value") - F.lit(30.0)).alias("delay_minutes"),
        (F.col("event_type") == F.lit("error")).alias("is_canceled"),
        F.to_date("ts").alias("event_date"))


# --- time slots -----------------------------------------------------------------

def time_dim(spark, sf_dir) -> DataFrame:
    """15-minute slots from the first event day to the last event."""
    return time_dimension(table(spark, sf_dir, "events").agg(start_of_day(F.min("ts")).alias("start"), F.max("ts").alias("end")))


def weekday_time_dim(spark, sf_dir) -> DataFrame:
    """The slots of working days only, so that events at weekends have none."""
    return time_dim(spark, sf_dir).filter(~F.col("is_weekend"))


def slotted_events(spark, sf_dir) -> DataFrame:
    """Event movements with their snapshot slot (the time-slot fact)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("user_id").alias("station_id"),
        (F.col("event_type") != F.lit("view")).alias("is_arrival"),
        (F.col("event_type") == F.lit("error")).alias("is_canceled"),
        floor_to_slot("ts").alias("slot_ts"))


# --- trains and names --------------------------------------------------------------

def train_stops(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_type").alias("category"),
        F.col("p_size").cast("string").alias("number"),
        F.col("p_brand").alias("owner"),
        F.col("p_partkey").alias("seen_order"))


def name_stations(spark, sf_dir) -> DataFrame:
    """Canonical names: one station per distinct part name, id = smallest key."""
    p = table(spark, sf_dir, "part")
    return p.groupBy(F.col("p_name").alias("station_name")).agg(F.min("p_partkey").alias("station_id"))


def messy(name_col):
    first = F.split_part(name_col, F.lit(" "), F.lit(1))
    second = F.split_part(name_col, F.lit(" "), F.lit(2))
    return F.concat(first.substr(1, 3), F.lit(". "), second)


def raw_names(spark, sf_dir) -> DataFrame:
    """Raw snapshot names: exact, prefixed, abbreviated, prefixed+abbreviated, overrides, one unknown."""
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("n")).distinct()
    variants = names.select(F.explode(F.array(
        F.col("n"), F.concat(F.lit("Berlin "), F.col("n")), messy(F.col("n")),
        F.concat(F.lit("Berlin "), messy(F.col("n"))))).alias("raw_name"))
    extra = spark.createDataFrame([(k,) for k in sorted(ROLE_OVERRIDES)] + [(ROLE_UNMATCHED,)], "raw_name string")
    return variants.unionByName(extra).distinct()


def abbreviated_pairs(spark, sf_dir) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("station_name")).distinct()
    return names.select(messy(F.col("station_name")).alias("search_name"), "station_name")


# --- graph ---------------------------------------------------------------------------

def graph_movements(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("train_id"),
        F.get_json_object("props", "$.k").cast("int").alias("station_id"),
        (~F.col("event_type").isin("view", "click", "signup")).alias("is_arrival"),
        F.col("ts").alias("planned_time"),
        F.col("event_id").alias("tie"))


def graph_stations(spark, sf_dir) -> DataFrame:
    g = graph_movements(spark, sf_dir).select("station_id").distinct()
    return g.select("station_id", F.format_string("st%03d", F.col("station_id")).alias("station_name"))


HOP_REQUESTS = [(1, "st000", "st050"), (2, "st007", "st093"), (3, "st012", "st012"),
                (4, "nowhere", "st001"), (5, "st099", "st000"), (6, "st031", "st064")]
ROUTE_REQUESTS = [(1, "st000", "st050", "2024-01-01 08:00"), (2, "st007", "st093", "2024-01-02 06:30"),
                  (3, "st012", "st012", "2024-01-03 12:00"), (4, "nowhere", "st001", "2024-01-01 08:00"),
                  (5, "st099", "st000", "2024-01-29 23:50"), (6, "st031", "st064", "2024-03-01 08:00"),
                  (7, "st045", "st002", "2024-01-10 17:15")]


def hop_requests(spark) -> DataFrame:
    return spark.createDataFrame(HOP_REQUESTS, "request_id int, origin_name string, destination_name string")


def route_requests(spark) -> DataFrame:
    return spark.createDataFrame(ROUTE_REQUESTS,
                                 "request_id int, origin_name string, destination_name string, depart_text string")


def customer_requests(spark, sf_dir) -> DataFrame:
    """One route request per customer: stations and departure follow from its keys."""
    first = table(spark, sf_dir, "events").agg(F.min("ts").alias("first"))
    c = table(spark, sf_dir, "customer").crossJoin(first)  # an aggregate of one row
    hours = F.make_dt_interval(F.lit(0), F.col("c_nationkey").cast("int"))
    return c.select(F.col("c_custkey").alias("request_id"),
                    F.format_string("st%03d", F.col("c_custkey") % 100).alias("origin_name"),
                    F.format_string("st%03d", (F.col("c_custkey") * 7 + F.col("c_nationkey")) % 100).alias("destination_name"),
                    (F.col("first") + hours).alias("depart_ts"))


def snapshot_fact(spark, sf_dir) -> DataFrame:
    """A fact with trains in which a stop event has a row per snapshot."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("train_id"), F.col("l_suppkey").alias("station_id"),
                     F.col("l_orderkey").alias("stop_id"), (F.col("l_linestatus") == F.lit("F")).alias("is_arrival"),
                     F.col("l_shipdate").alias("planned_time"), *[F.col(c) for c in SNAPSHOT_ORDER])


def star_fact(spark, sf_dir) -> DataFrame:
    """Rows of the star schema's fact: a stop event per snapshot with its planned time."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return li.join(o, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("l_suppkey").alias("station_id"), F.col("l_linenumber").alias("time_id"),
        F.concat(F.lit("T-"), F.col("l_partkey").cast("string")).alias("train_id"), F.col("l_orderkey").alias("stop_id"),
        (F.col("l_linestatus") == F.lit("F")).alias("is_arrival"), F.col("o_orderdate").alias("planned_time"))


def star_changes(spark, sf_dir) -> DataFrame:
    """Changes to stop events of the star fact: the updates with station and direction."""
    li = table(spark, sf_dir, "lineitem")
    at = li.select(F.col("l_suppkey").alias("station_id"), F.col("l_orderkey").cast("string").alias("stop_id"),
                   (F.col("l_linestatus") == F.lit("F")).alias("is_arrival"), F.col("l_returnflag"), *SNAPSHOT_ORDER)
    kind = F.col("l_returnflag")
    return at.select(
        "station_id", "stop_id", "is_arrival", F.when(kind != F.lit("N"), F.col("l_shipdate")).alias("ct"),
        F.when(kind != F.lit("A"), F.col("l_partkey").cast("string")).alias("cp"), F.when(kind == F.lit("R"), F.lit("c")).alias("cs"),
        F.when(F.col("is_arrival"), F.col("l_shipdate")).alias("clt"), *SNAPSHOT_ORDER)


# --- XML snapshot documents --------------------------------------------------------------

# Stops per document are bounded: a document holds the events of one station
# whose ids share ``event_id // DOC_GROUP`` (at most DOC_GROUP stops).
DOC_GROUP = 16


def _event_xml_parts(e: DataFrame, change: bool) -> DataFrame:
    from railyard.functions.timefmt import floor_to_slot, format_compact_ts  # local: avoid cycles
    et = F.col("event_type")
    pt = format_compact_ts("ts")
    platform = (F.floor("value").cast("int") % 12).cast("string")
    category = F.when(et == F.lit("purchase"), F.lit("Bus")).otherwise(et)
    tl = F.when(et == F.lit("signup"), F.lit("")).otherwise(
        F.concat(F.lit('<tl c="'), category, F.lit('" n="'), F.col("user_id").cast("string"),
                 F.lit('" o="'), et, F.lit('"/>')))

    def attr(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f' {name}="'), value, F.lit('"'))).otherwise(F.lit(""))

    if change:
        ct = F.when(F.col("value") >= 30, format_compact_ts(
            F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"))))
        attrs = F.concat(attr("ct", ct), attr("cp", F.when(et == F.lit("click"), platform)),
                         attr("cs", F.when(et == F.lit("error"), F.lit("c"))),
                         attr("clt", F.when((et == F.lit("error")) & (F.col("value") > 50), pt)))
        ar_attrs = dp_attrs = attrs
    else:
        ar_attrs = F.concat(attr("pt", pt), attr("pp", platform))
        dp_attrs = F.concat(ar_attrs, attr("cs", F.when(et == F.lit("error"), F.lit("c"))),
                            attr("clt", F.when(et == F.lit("error"), pt)))
    has_ar = et.isin("click", "signup", "purchase")
    has_dp = et.isin("view", "signup", "error")
    s = F.concat(F.lit('<s id="'), F.col("event_id").cast("string"), F.lit('">'), tl,
                 F.when(has_ar, F.concat(F.lit("<ar"), ar_attrs, F.lit("/>"))).otherwise(F.lit("")),
                 F.when(has_dp, F.concat(F.lit("<dp"), dp_attrs, F.lit("/>"))).otherwise(F.lit("")),
                 F.lit("</s>"))
    return e.select("user_id", "event_id", "ts", "event_type", F.floor(F.col("event_id") / DOC_GROUP).alias("grp"),
                    s.alias("s"), floor_to_slot("ts").alias("slot"))


def event_documents(spark, sf_dir, change: bool = False, corrupt: bool = False) -> DataFrame:
    """``file_path, snapshot_ts, value``: one XML document per (station, id group).

    With ``corrupt`` the documents whose first stop is an 'error' event are cut
    in half (malformed XML).
    """
    from railyard.functions.timefmt import format_compact_ts
    parts = _event_xml_parts(table(spark, sf_dir, "events"), change)
    docs = parts.groupBy("user_id", "grp").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "s"))).alias("stops"),
        F.min("slot").alias("snapshot_ts"),
        F.min_by("event_type", "event_id").alias("first_type"))
    text = F.concat(F.lit('<timetable station="'), F.col("user_id").cast("string"), F.lit('">'),
                    F.array_join(F.transform("stops", lambda x: x["s"]), ""), F.lit("</timetable>"))
    if corrupt:
        text = F.when(F.col("first_type") == F.lit("error"),
                      text.substr(F.lit(1), (F.length(text) / 2).cast("int"))).otherwise(text)
    suffix = "_change.xml" if change else "_timetable.xml"
    path = F.concat(F.lit("/snapshots/"), format_compact_ts("snapshot_ts"), F.lit("/"),
                    F.col("user_id").cast("string"), F.lit("_"), F.col("grp").cast("string"), F.lit(suffix))
    return docs.select(path.alias("file_path"), "snapshot_ts", text.alias("value"))


# Stations of the documents that are written as files, and ids that share a file at most.
FILE_STATIONS, FILE_IDS = 16, 65_536


def snapshot_file_root(spark, sf_dir, change: bool = False) -> str:
    """Write documents of stop events as files, ``<root>/<day>/<station>_<n>_<kind>.xml``, and return the root.

    Spark writes one text per file; the files then get the names that a scan looks for.
    """
    from railyard.functions.timefmt import format_compact_ts, start_of_day
    from railyard.session import scratch_path
    parts = _event_xml_parts(table(spark, sf_dir, "events"), change)
    station = F.concat(F.lit("g"), (F.col("user_id") % FILE_STATIONS).cast("string"))
    docs = parts.groupBy(start_of_day(F.col("ts")).alias("day"), station.alias("station"), F.floor(F.col("event_id") / FILE_IDS).alias("n")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "s"))).alias("stops"))
    text = F.concat(F.lit('<timetable station="'), F.col("station"), F.lit('">'),
                    F.array_join(F.transform("stops", lambda x: x["s"]), ""), F.lit("</timetable>"))
    suffix = "_change.xml" if change else "_timetable.xml"
    name = F.concat("station", F.lit("_"), F.col("n").cast("string"), F.lit(suffix))
    root = scratch_path(spark, "snapshots")
    docs.select(format_compact_ts("day").alias("folder"), name.alias("file"), text.alias("value")).repartition("folder", "file") \
        .write.partitionBy("folder", "file").text(f"{root}/_written")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in files.listStatus(path(f"{root}/_written")):
        day = folder.getPath().getName().removeprefix("folder=")
        if folder.isDirectory():
            files.mkdirs(path(f"{root}/files/{day}"))
            for file in files.listStatus(folder.getPath()):
                one = files.listStatus(file.getPath())[0].getPath()
                files.rename(one, path(f"{root}/files/{day}/{file.getPath().getName().removeprefix('file=')}"))
    return f"{root}/files"


# --- station JSON documents --------------------------------------------------------------

JSON_GROUP = 16


def station_json(spark, sf_dir) -> DataFrame:
    """``value``: ``{"result": [...]}`` documents of at most JSON_GROUP suppliers each.

    Per supplier: a non-main EVA entry first, then the main one (absent when
    nationkey % 5 = 3, coordinates cut to [lon] when nationkey % 5 = 1);
    hasWiFi is missing, a JSON boolean, or text in mixed case.
    """
    s = table(spark, sf_dir, "supplier")
    lat = F.col("s_nationkey").cast("double")
    lon = F.col("s_acctbal") / F.lit(1000.0)
    coords = F.when(F.col("s_nationkey") % 5 == 1, F.array(lon)).otherwise(F.array(lon, lat))
    entry = lambda num, main, c: F.struct(num.alias("number"), F.lit(main).alias("isMain"),
                                          F.struct(c.alias("coordinates")).alias("geographicCoordinates"))
    other = entry(F.col("s_suppkey") + F.lit(1_000_000), False, F.array(lon + 1, lat + 1))
    evas = F.when(F.col("s_nationkey") % 5 == 3, F.array(other)).otherwise(
        F.array(other, entry(F.col("s_suppkey"), True, coords)))
    wifi_mode = F.col("s_nationkey") % 4
    wifi = (F.when(wifi_mode == 1, F.lit("__JSON_TRUE__"))
            .when(wifi_mode == 2, F.when(F.col("s_acctbal") > 2500, F.lit("True")).otherwise(F.lit("false")))
            .when(wifi_mode == 3, F.lit("FALSE")))
    station = F.struct(
        F.col("s_name").alias("name"),
        F.concat(F.lit("de:11000:"), F.col("s_suppkey").cast("string")).alias("ifopt"),
        (F.col("s_nationkey") % 7).alias("category"),
        (F.col("s_nationkey") % 3 + 1).alias("priceCategory"),
        F.when(F.col("s_acctbal") < 0, F.lit("no")).when(F.col("s_acctbal") < 5000, F.lit("partial"))
         .otherwise(F.lit("yes")).alias("hasSteplessAccess"),
        wifi.alias("hasWiFi"),
        F.struct(F.lpad((F.lit(10000) + F.col("s_suppkey") % 90000).cast("string"), 5, "0").alias("zipcode"))
         .alias("mailingAddress"),
        evas.alias("evaNumbers"))
    grouped = s.select(F.floor(F.col("s_suppkey") / JSON_GROUP).alias("grp"), F.col("s_suppkey"),
                       F.to_json(station).alias("j"))
    docs = grouped.groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "j"))).alias("items"))
    text = F.concat(F.lit('{"result": ['), F.array_join(F.transform("items", lambda x: x["j"]), ", "), F.lit("]}"))
    return docs.select(F.regexp_replace(text, '"__JSON_TRUE__"', "true").alias("value"))
