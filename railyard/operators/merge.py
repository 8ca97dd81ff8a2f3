"""Merging planned events with ordered updates.

Both merges are single aggregations keyed by the stop event; ``max_by`` with a
``when(cond, order)`` ordering acts as ``max_by ... FILTER (WHERE cond)``
because rows with a null ordering never win. Aggregates combine map-side, so a
stop with millions of updates costs one buffer per task, and the result does
not depend on input order (order is the explicit ``order`` columns).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from railyard.functions.movement import (cancelled_flag, event_delay, nonempty, reference_date,
                                         warehouse_delay)
from railyard.operators.latest import first_per_key
from railyard.session import write_table

# What a counted load says of itself.
LOAD_COUNTS = ("n_rows", "n_updated", "n_updates", "n_without_row")


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def relevant_updates(updates: DataFrame, time_text: str = "ct", platform: str = "cp",
                     status: str = "cs") -> DataFrame:
    """Warehouse rule: an update counts only if it carries a time, platform or status."""
    t = F.col(time_text)
    has_time = nonempty(t).isNotNull() if dict(updates.dtypes)[time_text] == "string" else t.isNotNull()
    return updates.filter(has_time | nonempty(F.col(platform)).isNotNull() | nonempty(F.col(status)).isNotNull())


def fold_updates_coalesce(updates: DataFrame, keys: Sequence[str], order: Sequence[str],
                          actual_time: str = "actual_time", platform: str = "cp",
                          cancelled: str = "cancelled") -> DataFrame:
    """Per key: last non-null time, last non-empty platform, OR of cancellations."""
    ordc = _order(order)
    t, p = F.col(actual_time), nonempty(F.col(platform))
    return updates.groupBy(*keys).agg(
        F.max_by(t, F.when(t.isNotNull(), ordc)).alias("upd_actual_time"),
        F.max_by(p, F.when(p.isNotNull(), ordc)).alias("upd_platform"),
        F.bool_or(F.col(cancelled)).alias("upd_cancelled"),
        F.count(F.lit(1)).alias("n_updates"))


def update_merge_coalesce(plan: DataFrame, updates: DataFrame, keys: Sequence[str],
                          order: Sequence[str]) -> DataFrame:
    """Warehouse merge: apply all relevant updates of a stop event to its plan row(s).

    ``plan``: keys, planned_time[, planned_platform, actual_time, actual_platform, delay_minutes, is_canceled];
    a frame that this function returned is a plan again, and later updates change only what they carry.
    ``updates``: keys, ct (timestamp), cp, cs, clt, order columns.
    Updates without a plan row are dropped (left join from the plan). The
    cancellation flag is sticky; null updates keep the old value; the delay
    follows a new time and is the old one without.
    """
    upd = relevant_updates(updates).withColumn("cancelled", cancelled_flag("cs", "clt"))
    return apply_fold(plan, fold_updates_coalesce(upd, keys, order, actual_time="ct", platform="cp"), keys)


def apply_fold(plan: DataFrame, folded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plan rows with the folded updates of their stop event (``upd_actual_time, upd_platform, upd_cancelled``)."""
    return folded_columns(plan.join(folded, list(keys), "left"), plan.columns)


def folded_columns(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The plan's ``columns`` with what the joined fold changes in them."""
    cols = set(columns)
    base_cancel = F.coalesce(F.col("is_canceled"), F.lit(False)) if "is_canceled" in cols else F.lit(False)
    base_platform = F.col("actual_platform") if "actual_platform" in cols else F.lit(None).cast("string")
    base_actual = F.col("actual_time") if "actual_time" in cols else F.lit(None).cast("timestamp_ntz")
    base_delay = F.col("delay_minutes") if "delay_minutes" in cols else F.lit(None).cast("int")
    actual = F.col("upd_actual_time")
    return joined.select(
        *[F.col(c) for c in columns if c not in ("actual_time", "actual_platform", "is_canceled", "delay_minutes")],
        F.coalesce(actual, base_actual).alias("actual_time"),
        F.coalesce(F.col("upd_platform"), base_platform).alias("actual_platform"),
        F.when(actual.isNotNull(), warehouse_delay("planned_time", actual)).otherwise(base_delay).alias("delay_minutes"),
        (base_cancel | F.coalesce(F.col("upd_cancelled"), F.lit(False))).alias("is_canceled"))


def tag_events(plan: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Bag union (UNION ALL) of plan and update events with a ``kind`` tag."""
    p = plan.select(*keys, F.lit("plan").alias("kind"), "planned_time",
                    F.lit(None).cast("timestamp_ntz").alias("actual_time"),
                    F.lit(None).cast("boolean").alias("is_canceled"), *order)
    u = updates.select(*keys, F.lit("update").alias("kind"), F.lit(None).cast("timestamp_ntz").alias("planned_time"),
                       F.col("actual_time"), F.col("is_canceled"), *order)
    return p.unionByName(u)


def event_merge_overwrite(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Spark-path merge of tagged events: per key, the last plan sets the planned
    time and the last update sets actual time and cancellation (also to null /
    false). Keys compare null-safely (``groupBy``), updates without a plan are
    kept with a null planned time. Delay is 0.0 unless both times exist.
    """
    ordc = _order(order)
    is_plan = F.col("kind") == F.lit("plan")
    agg = events.groupBy(*keys).agg(
        F.max_by(F.col("planned_time"), F.when(is_plan, ordc)).alias("planned_time"),
        F.max_by(F.struct("actual_time", "is_canceled"), F.when(~is_plan, ordc)).alias("_u"))
    return agg.select(
        *keys, "planned_time", F.col("_u.actual_time").alias("actual_time"),
        event_delay("planned_time", F.col("_u.actual_time")).alias("delay_minutes"),
        F.coalesce(F.col("_u.is_canceled"), F.lit(False)).alias("is_canceled"),
        reference_date("planned_time", F.col("_u.actual_time")).alias("event_date"))


def fact_dedup(fact: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per unique key (insert order wins), missing cancellation -> false."""
    out = first_per_key(fact, keys, order)
    if "is_canceled" in out.columns:
        out = out.withColumn("is_canceled", F.coalesce(F.col("is_canceled"), F.lit(False)))
    return out


def fact_insert_new(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING: de-duplicated batch rows whose key is new, appended."""
    fresh = fact_dedup(batch, keys, order).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def counted_load(plan: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """``update_merge_coalesce`` written as a table, with counts taken by the same job.

    ``n_rows`` of the plan, ``n_updated`` rows that got updates, ``n_updates`` seen
    and ``n_without_row`` of them that no row of the plan takes.
    """
    upd = relevant_updates(updates).withColumn("cancelled", cancelled_flag("cs", "clt"))
    of_fold, of_rows = (Observation(f"railyard_load_{uuid.uuid4().hex[:8]}") for _ in range(2))
    folded = fold_updates_coalesce(upd, keys, order, actual_time="ct", platform="cp").observe(
        of_fold, F.coalesce(F.sum("n_updates"), F.lit(0)).alias("n_updates"))
    has_row = F.col("_row").isNotNull()
    n = F.coalesce(F.col("n_updates"), F.lit(0))
    # A full join, so that updates without a row are met in the one pass over both.
    both = plan.withColumn("_row", F.lit(True)).join(folded, list(keys), "full_outer").observe(
        of_rows, F.count_if(has_row).alias("n_rows"), F.count_if(has_row & (n > 0)).alias("n_updated"),
        F.coalesce(F.sum(F.when(~has_row, n)), F.lit(0)).alias("n_without_row"))
    merged = write_table(folded_columns(both.filter(has_row), plan.columns), "load")
    seen = of_fold.get | of_rows.get
    return merged, {c: int(seen[c]) for c in LOAD_COUNTS}


def snapshot_counts(fact: DataFrame, slot_cols: Sequence[str]) -> DataFrame:
    """Load metrics per snapshot: movements, arrivals, cancellations."""
    return fact.groupBy(*slot_cols).agg(
        F.count(F.lit(1)).alias("n_movements"),
        F.count_if(F.col("is_arrival")).alias("n_arrivals"),
        F.count_if(F.col("is_canceled")).alias("n_canceled"))
