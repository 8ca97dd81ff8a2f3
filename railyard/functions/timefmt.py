"""Time parsing, slot flooring and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railyard.constants import PEAK_HOURS, SLOT_MINUTES


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_compact_ts(col) -> Column:
    """``yyMMddHHmm`` text -> timestamp_ntz; empty, malformed or impossible -> null.

    Two-digit years follow the POSIX pivot (00-68 -> 20xx, 69-99 -> 19xx). The
    value is built field by field, so no session time zone is involved.
    """
    s = F.trim(_c(col))
    ok = s.rlike(r"^[0-9]{10}$")
    yy = s.substr(1, 2).cast("int")
    year = F.when(yy < 69, yy + 2000).otherwise(yy + 1900)
    ts = F.try_make_timestamp_ntz(
        year, s.substr(3, 2).cast("int"), s.substr(5, 2).cast("int"),
        s.substr(7, 2).cast("int"), s.substr(9, 2).cast("int"), F.lit(0))
    return F.when(ok, ts)


def format_compact_ts(col) -> Column:
    """timestamp -> ``yyMMddHHmm`` text (minute precision)."""
    return F.date_format(_c(col), "yyMMddHHmm")


def parse_route_time(col) -> Column:
    """``yyyy-MM-dd HH:mm`` text -> timestamp_ntz, null when malformed."""
    s = F.trim(_c(col))
    ok = s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}$")
    ts = F.try_make_timestamp_ntz(
        s.substr(1, 4).cast("int"), s.substr(6, 2).cast("int"), s.substr(9, 2).cast("int"),
        s.substr(12, 2).cast("int"), s.substr(15, 2).cast("int"), F.lit(0))
    return F.when(ok, ts)


def floor_to_slot(col, minutes: int = SLOT_MINUTES) -> Column:
    """Floor a timestamp_ntz to the start of its ``minutes``-wide slot (``minutes`` divides 60).

    Built field by field as timestamp_ntz, so no session time zone is involved.
    """
    c = _c(col)
    mins = (F.floor(F.minute(c) / minutes) * minutes).cast("int")
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), mins, F.lit(0))


def start_of_day(col) -> Column:
    """Midnight of the timestamp's date, as timestamp_ntz."""
    return F.to_date(_c(col)).cast("timestamp_ntz")


def is_peak_hour(col, peak_hours=PEAK_HOURS) -> Column:
    return F.hour(_c(col)).isin(*peak_hours)


def is_weekend(col) -> Column:
    # weekday(): Monday = 0 ... Sunday = 6
    return F.weekday(_c(col)) >= 5


def day_name(col) -> Column:
    return F.date_format(_c(col), "EEEE")
