"""Timetable XML snapshots.

A document is one station's timetable at one snapshot: root attribute
``station``, children ``s[@id]`` with optional ``tl[@c,@n,@o]`` and attribute-only
``ar`` / ``dp`` elements. Documents come either from snapshot folders
(``<root>/<yyMMddHHmm>/*_timetable.xml`` / ``*_change.xml``, one file per
document, read whole) or from any DataFrame with a text column. Parsing is
``from_xml`` with a declared schema, so it stays in the JVM; the root tag is
irrelevant and malformed or empty text yields no rows and is reported.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.constants import (CHANGE_FILE_SUFFIX, DEFAULT_CATEGORY, DEFAULT_TRAIN_NUMBER,
                                EXCLUDED_CATEGORY, NAME_PREFIX, PLAN_FILE_SUFFIX)
from railyard.functions.movement import cancelled_flag, nonempty, train_id
from railyard.functions.names import normalize_names
from railyard.functions.timefmt import parse_compact_ts
from railyard.schemas import TIMETABLE_XML

# A scan's partitions that one task reads: Spark counts 4 MB for opening a file, which is far more than such a file holds.
PACKED = 16
XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


# --- scans -------------------------------------------------------------------------

def snapshot_folders(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> list[str]:
    """Folders right below ``root``; with bounds (``yyMMddHHmm``, half-open) only snapshot folders within them.

    One listing of one level, whatever the number of files; names sort as their times do.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in files.listStatus(path) if f.isDirectory())
    if since is not None or until is not None:
        names = [n for n in names if re.fullmatch(r"\d{10}", n)]
    return [n for n in names if (since is None or n >= since) and (until is None or n < until)]


def scan_snapshot_files(spark: SparkSession, root: str, suffix: str = PLAN_FILE_SUFFIX, validate_folder: bool = True,
                        since: str | None = None, until: str | None = None) -> DataFrame:
    """``file_path, snapshot_ts, value`` for every ``<root>/<folder>/*<suffix>`` file.

    The folder name is the snapshot time (``yyMMddHHmm``); with
    ``validate_folder`` files in folders with another name are skipped (plan
    scan); the change scan keeps them with a null snapshot time. ``since`` and
    ``until`` bound the folders that are listed at all, so that a later scan
    looks at new ones only. Small files are packed many to a task.
    """
    folders = snapshot_folders(spark, root, since, until)
    if not folders:
        return spark.createDataFrame([], "file_path string, snapshot_ts timestamp_ntz, value string")
    # Files are listed by Spark (in parallel where there are many folders), not expanded from a pattern on the driver.
    df = (spark.read.format("text").option("wholetext", True).option("pathGlobFilter", f"*{suffix}")
          .load([f"{root.rstrip('/')}/{f}" for f in folders])
          .select(F.col("_metadata.file_path").alias("file_path"), "value"))
    tasks = df.rdd.getNumPartitions()
    df = df.coalesce(max(1, min(tasks, spark.sparkContext.defaultParallelism), tasks // PACKED))
    out = df.withColumn("snapshot_ts", parse_compact_ts(F.element_at(F.split("file_path", "/"), -2)))
    if validate_folder:
        out = out.filter(F.col("snapshot_ts").isNotNull())
    return out.select("file_path", "snapshot_ts", "value")


def is_change_file(path_col: str = "file_path") -> Column:
    return F.col(path_col).endswith(CHANGE_FILE_SUFFIX)


# --- parsing -------------------------------------------------------------------------

def parse_documents(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Add ``doc`` (parsed struct) and ``doc_ok`` (well-formed) columns."""
    parsed = docs.withColumn("doc", F.from_xml(F.col(text_col), TIMETABLE_XML, XML_OPTIONS))
    ok = (nonempty(F.trim(F.col(text_col))).isNotNull() & F.col("doc._corrupt_record").isNull()
          & (F.col("doc._station").isNotNull() | F.col("doc.s").isNotNull()))
    return parsed.withColumn("doc_ok", F.coalesce(ok, F.lit(False)))


def malformed_report(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Counts of documents, rejected (malformed or empty) documents and parsed stops."""
    p = parse_documents(docs, text_col)
    return p.agg(F.count(F.lit(1)).alias("n_documents"),
                 F.count_if(~F.col("doc_ok")).alias("n_rejected"),
                 F.sum(F.when(F.col("doc_ok"), F.coalesce(F.size("doc.s"), F.lit(0))).otherwise(0))
                 .cast("long").alias("n_stops"))


def stop_events(docs: DataFrame, text_col: str = "value", keep=("file_path", "snapshot_ts")) -> DataFrame:
    """One row per (document, stop, ar|dp) with the raw attribute text.

    Columns: kept document columns, ``station_raw``, ``pos`` (stop position in
    the document, a tie-break), ``stop_id``, ``tl_c``, ``tl_n``, ``tl_o``,
    ``has_tl``, ``is_arrival`` and ``pt, pp, ct, cp, cs, clt``. Documents with
    a missing or empty station give no rows.
    """
    keep = [c for c in keep if c in docs.columns]
    p = parse_documents(docs, text_col).filter(F.col("doc_ok") & nonempty(F.col("doc._station")).isNotNull())
    stops = p.select(*keep, F.col("doc._station").alias("station_raw"),
                     F.posexplode(F.col("doc.s")).alias("pos", "st"))
    members = F.array(F.struct(F.lit(True).alias("is_arrival"), F.col("st.ar").alias("e")),
                      F.struct(F.lit(False).alias("is_arrival"), F.col("st.dp").alias("e")))
    ev = stops.select(*keep, "station_raw", "pos", F.col("st._id").alias("stop_id"),
                      F.col("st.tl").isNotNull().alias("has_tl"), F.col("st.tl._c").alias("tl_c"),
                      F.col("st.tl._n").alias("tl_n"), F.col("st.tl._o").alias("tl_o"),
                      F.explode(members).alias("m")).filter(F.col("m.e").isNotNull())
    return ev.select(*keep, "station_raw", "pos", "stop_id", "has_tl", "tl_c", "tl_n", "tl_o",
                     F.col("m.is_arrival").alias("is_arrival"),
                     *[F.col(f"m.e._{a}").alias(a) for a in ("pt", "pp", "ct", "cp", "cs", "clt")])


# --- warehouse path ----------------------------------------------------------------

def warehouse_plan_rows(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Planned rows: stops need ``tl``; category ``Bus`` excluded; unknown category passes."""
    ev = stop_events(docs, text_col)
    ev = ev.filter(F.col("has_tl") & ~F.coalesce(F.col("tl_c") == F.lit(EXCLUDED_CATEGORY), F.lit(False)))
    return ev.select(
        F.col("station_raw").alias("station_name"), *[c for c in ("file_path", "snapshot_ts") if c in ev.columns],
        "pos", "stop_id", train_id("tl_c", "tl_n").alias("train_id"),
        F.col("tl_c").alias("line_category"), F.col("tl_n").alias("train_number"), F.col("tl_o").alias("owner_id"),
        "is_arrival", F.col("pp").alias("planned_platform"), parse_compact_ts("pt").alias("planned_time"),
        cancelled_flag("cs", "clt").alias("is_canceled"))


def warehouse_change_rows(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Change rows that carry a time, platform or status (``tl`` not required)."""
    ev = stop_events(docs, text_col)
    relevant = (nonempty(F.col("ct")).isNotNull() | nonempty(F.col("cp")).isNotNull()
                | nonempty(F.col("cs")).isNotNull())
    ev = ev.filter(relevant)
    return ev.select(
        F.col("station_raw").alias("station_name"), *[c for c in ("file_path", "snapshot_ts") if c in ev.columns],
        "pos", "stop_id", "is_arrival", parse_compact_ts("ct").alias("ct"), nonempty(F.col("cp")).alias("cp"),
        "cs", "clt", cancelled_flag("cs", "clt").alias("cancelled"))


# --- Spark path ----------------------------------------------------------------------

def movement_rows(docs: DataFrame, overrides: DataFrame, text_col: str = "value",
                  prefix: str = NAME_PREFIX) -> DataFrame:
    """Spark-path event rows tagged ``plan`` / ``update`` by file suffix.

    Station names are normalised (override, else prefix strip); ``train_id`` is
    ``category-number`` with defaults, null when the stop has no ``tl``; stops
    of category ``Bus`` are dropped. Every ``ar``/``dp`` of a change file is an
    update (no relevance filter). The order key is (snapshot, file, stop position).
    """
    ev = stop_events(docs, text_col)
    category = F.coalesce(F.col("tl_c"), F.lit(DEFAULT_CATEGORY))
    number = F.coalesce(F.col("tl_n"), F.lit(DEFAULT_TRAIN_NUMBER))
    ev = ev.filter(~(F.col("has_tl") & (category == F.lit(EXCLUDED_CATEGORY))))
    ev = normalize_names(ev, "station_raw", overrides, prefix, out_col="station_name")
    change = is_change_file("file_path")
    return ev.select(
        "station_name", "stop_id",
        F.when(F.col("has_tl"), F.concat(category, F.lit("-"), number)).alias("train_id"),
        "is_arrival",
        F.when(change, F.lit("update")).otherwise(F.lit("plan")).alias("kind"),
        F.when(~change, parse_compact_ts("pt")).alias("planned_time"),
        F.when(change, parse_compact_ts("ct")).alias("actual_time"),
        F.when(change, cancelled_flag("cs", "clt")).alias("is_canceled"),
        "snapshot_ts", "file_path", "pos")
