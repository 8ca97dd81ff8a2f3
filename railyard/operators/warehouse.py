"""Star-schema load from snapshot documents (the warehouse path end to end).

plan documents -> plan rows -> station ids (override / exact / fuzzy) -> time
slot of the snapshot -> trains (first owner wins) -> fact rows de-duplicated on
the unique key (first file, first stop wins); change documents -> relevant
changes -> coalesce merge into every snapshot row of the stop event.
Rows whose station or snapshot slot cannot be resolved are returned as rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.constants import NAME_PREFIX
from railyard.operators.dims import has_train, train_dimension, with_surrogate_key
from railyard.operators.merge import counted_load, fact_dedup
from railyard.operators.resolve import resolve_names
from railyard.schemas import FACT_UNIQUE_KEY
from railyard.session import write_table
from railyard.sources.xml import warehouse_change_rows, warehouse_plan_rows

DOC_ORDER = ["file_path", "pos"]


def _resolved(rows: DataFrame, stations: DataFrame, overrides: DataFrame, prefix: str) -> DataFrame:
    names = resolve_names(rows.select(F.col("station_name").alias("raw_name")), stations, overrides, prefix)
    return rows.join(names.select(F.col("raw_name").alias("station_name"), "station_id", "reason"),
                     "station_name", "left")


def load_fact(plan_docs: DataFrame, stations: DataFrame, dim_time: DataFrame, overrides: DataFrame,
              prefix: str = NAME_PREFIX) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Return ``(fact, dim_train, rejects)`` from plan documents with ``file_path, snapshot_ts, value``."""
    rows = _resolved(warehouse_plan_rows(plan_docs), stations, overrides, prefix)
    slots = dim_time.select(F.col("slot_ts").alias("snapshot_ts"), "time_id")
    rows = rows.join(slots, "snapshot_ts", "left")
    # One rule for facts, trains and rejects: a fact never names a train that the dimension lacks.
    known_train = has_train(F.col("line_category"), F.col("train_number"))
    ok = F.col("station_id").isNotNull() & F.col("time_id").isNotNull() & known_train
    rejects = rows.filter(~ok).select(
        "file_path", "station_name", "stop_id",
        F.coalesce(F.col("reason"), F.when(F.col("time_id").isNull(), F.lit("no time slot")),
                   F.lit("incomplete train")).alias("reason"))
    good = rows.filter(ok)
    trains = train_dimension(good.select(F.col("line_category").alias("category"), F.col("train_number").alias("number"),
                                         F.col("owner_id").alias("owner"),
                                         F.struct(*DOC_ORDER).alias("seen_order")))
    fact = fact_dedup(good.select(*FACT_UNIQUE_KEY, "train_id", "planned_platform", "planned_time", "is_canceled",
                                  *DOC_ORDER), list(FACT_UNIQUE_KEY), DOC_ORDER)
    return with_surrogate_key(fact.drop(*DOC_ORDER), FACT_UNIQUE_KEY), trains, rejects


def apply_changes(fact: DataFrame, change_docs: DataFrame, stations: DataFrame, overrides: DataFrame,
                  prefix: str = NAME_PREFIX) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Coalesce-merge every relevant change into the fact rows of its (station, stop, is_arrival).

    Returns the fact (written once), the changes whose station is not known
    with the reason, and the counts of the load with ``n_unresolved`` of them.
    """
    rows = write_table(_resolved(warehouse_change_rows(change_docs), stations, overrides, prefix), "changes")
    known = F.col("station_id").isNotNull()
    rejects = rows.filter(~known).select("file_path", "station_name", "stop_id", "reason")
    merged, counts = counted_load(fact, rows.filter(known), ["station_id", "stop_id", "is_arrival"], ["snapshot_ts", "file_path", "pos"])
    return merged, rejects, counts | {"n_unresolved": rejects.count()}


def movement_events(docs: DataFrame, overrides: DataFrame, prefix: str = NAME_PREFIX) -> DataFrame:
    """Spark path end to end: plan and change documents -> merged movement events.

    Keyed by (station_name, stop_id, train_id, is_arrival) with a null-safe
    train id; later snapshots win field by field (planned time from plans,
    actual time and cancellation from changes). Write with
    ``sources.parquet.write_movement_events``.
    """
    from railyard.operators.merge import event_merge_overwrite
    from railyard.sources.xml import movement_rows
    rows = movement_rows(docs, overrides, prefix=prefix)
    return event_merge_overwrite(rows, ["station_name", "stop_id", "train_id", "is_arrival"],
                                 ["snapshot_ts", "file_path", "pos"])
