"""Incremental ingest of change snapshot folders.

New ``<root>/<yyMMddHHmm>/*_change.xml`` files are picked up by a file-source
stream; each micro-batch is parsed (same operators as the batch path), written
to an append-only change log, one folder per batch id, and merged into a stored
fold of all changes. A replayed batch overwrites its own output in the log, and
is not merged a second time (exactly-once with the stream checkpoint).

The fold keeps, per stop event and field, the winning value with its order, so
it can be merged with later and with late changes alike. It is divided into
buckets of keys behind a manifest (``sources/versions.py``): a batch reads and
writes only the buckets of its keys, and no file of the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.constants import CHANGE_FILE_SUFFIX
from railyard.functions.movement import cancelled_flag, nonempty
from railyard.functions.timefmt import parse_compact_ts
from railyard.operators.merge import apply_fold, relevant_updates
from railyard.session import drop_table, write_table
from railyard.sources.versions import Versions
from railyard.sources.xml import warehouse_change_rows

LOG_COLUMNS = ["station_name", "file_path", "snapshot_ts", "pos", "stop_id", "is_arrival", "ct", "cp", "cs", "clt"]
KEYS = ("station_name", "stop_id", "is_arrival")
ORDER = ("snapshot_ts", "file_path", "pos")
FOLD = "fold"
# Buckets of keys of a stored fold; a manifest has a line for each.
BUCKETS = 64


def fold_of_updates(updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Mergeable fold of changes: per key ``time`` and ``platform`` as structs of order and value, ``cancelled``, ``n_updates``."""
    upd = relevant_updates(updates)
    at = F.struct(*[F.col(c) for c in order])

    def last(value: Column) -> Column:
        return F.max_by(F.struct(at.alias("at"), value.alias("value")), F.when(value.isNotNull(), at))

    return upd.groupBy(*keys).agg(last(F.col("ct")).alias("time"), last(nonempty(F.col("cp"))).alias("platform"),
                                  F.bool_or(cancelled_flag("cs", "clt")).alias("cancelled"), F.count(F.lit(1)).alias("n_updates"))


def merge_folds(folds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key from rows of several folds."""
    latest = lambda c: F.max_by(c, F.col(f"{c}.at"))
    return folds.groupBy(*keys).agg(latest("time").alias("time"), latest("platform").alias("platform"),
                                    F.bool_or("cancelled").alias("cancelled"), F.sum("n_updates").alias("n_updates"))


def merge_into_fold(updates: DataFrame, root: str, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
                    batch: tuple[str, int] | None = None) -> list[str]:
    """Merge changes into the fold stored under ``root``; returns the buckets that were written.

    ``batch``: name of a stream and number of its batch; one that has been merged is left out.
    """
    store = Versions(updates.sparkSession, root)
    now = store.current()
    if batch is not None and now["notes"].get(batch[0], -1) >= batch[1]:
        return []
    keys = list(keys)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    new = write_table(fold_of_updates(updates, keys, order), "fold-batch")
    touched = [str(r["b"]) for r in new.select(bucket.alias("b")).distinct().collect()]
    old = store.read(FOLD, new.schema, touched, missing_ok=True)
    merged = merge_folds(old.unionByName(new), keys)
    store.commit({FOLD: store.write(FOLD, merged, bucket) if touched else {}}, notes=dict([batch]) if batch else None, on=now["number"])
    drop_table(new)
    return touched


def read_fold(spark: SparkSession, root: str, schema) -> DataFrame:
    return Versions(spark, root).read(FOLD, schema, missing_ok=True)


def view_of_fold(plan: DataFrame, fold: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The plan with the changes that a fold holds, as ``update_merge_coalesce`` of all of them gives."""
    flat = fold.select(*keys, F.col("time.value").alias("upd_actual_time"), F.col("platform.value").alias("upd_platform"),
                       F.col("cancelled").alias("upd_cancelled"), "n_updates")
    return apply_fold(plan, flat, list(keys))


def change_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(f"{root.rstrip('/')}/*/*{CHANGE_FILE_SUFFIX}")
    path = F.col("_metadata.file_path")
    return raw.select(path.alias("file_path"),
                      parse_compact_ts(F.element_at(F.split(path, "/"), -2)).alias("snapshot_ts"), "value")


def ingest_changes(spark: SparkSession, root: str, log_path: str, checkpoint_location: str, fold_root: str | None = None,
                   available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start (and with ``available_now`` finish) the ingest; returns the StreamingQuery.

    ``checkpoint_location`` is what makes a later call go on where the last
    one ended, so there is no default. With ``fold_root`` each batch is merged
    into the fold there.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        folder = f"{log_path.rstrip('/')}/batch_id={batch_id}"
        rows = warehouse_change_rows(batch).select(*LOG_COLUMNS)
        rows.write.mode("overwrite").parquet(folder)
        if fold_root is not None:
            # Read back from the log, so that documents are parsed once.
            merge_into_fold(batch.sparkSession.read.schema(rows.schema).parquet(folder), fold_root, batch=(checkpoint_location, batch_id))

    writer = (change_stream(spark, root, max_files_per_trigger).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_change_log(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.parquet(log_path)


def fold_schema(change_log: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER):
    """Schema of the fold of such changes."""
    return fold_of_updates(change_log.limit(0), keys, order).schema


def merged_view(plan: DataFrame, root: str, change_log: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """The plan with every change merged into the fold under ``root``; of the log only the schema is used."""
    return view_of_fold(plan, read_fold(plan.sparkSession, root, fold_schema(change_log, keys, order)), keys)
