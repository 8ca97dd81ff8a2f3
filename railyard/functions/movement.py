"""Movement expressions: cancellation flag, delay, reference date, ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railyard.constants import CANCELLED_STATUS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cancelled_flag(status, cancel_time) -> Column:
    """Cancelled when status is 'c' and a cancellation time is present."""
    return F.coalesce((_c(status) == F.lit(CANCELLED_STATUS)) & _c(cancel_time).isNotNull(), F.lit(False))


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def warehouse_delay(planned, actual) -> Column:
    """Whole minutes ``greatest(0, (actual - planned) / 60)`` stored as integer.

    Null actual -> null. Null planned with an actual -> 0, because ``greatest``
    skips nulls (as the warehouse's GREATEST does).
    """
    minutes = seconds_between(planned, actual) / F.lit(60.0)
    return F.when(_c(actual).isNotNull(),
                  F.round(F.greatest(F.lit(0.0), minutes), 0).cast("int"))


def event_delay(planned, actual) -> Column:
    """Spark-path delay: minutes as double, 0.0 unless both times are present."""
    minutes = seconds_between(planned, actual) / F.lit(60.0)
    return (F.when(_c(planned).isNotNull() & _c(actual).isNotNull(),
                   F.greatest(F.lit(0.0), minutes))
            .otherwise(F.lit(0.0)))


def reference_date(planned, actual) -> Column:
    """Date of the planned time, else of the actual time, else null."""
    return F.to_date(F.coalesce(_c(planned), _c(actual)))


def text_to_bool(col) -> Column:
    """'true' in any case -> true; anything else, null included -> false."""
    return F.coalesce(F.lower(_c(col)) == F.lit("true"), F.lit(False))


def train_id(category, number) -> Column:
    """Composite ``category-number``; null if either part is null."""
    return F.concat(_c(category), F.lit("-"), _c(number))


def nonempty(col) -> Column:
    return F.nullif(_c(col), F.lit(""))
