"""Generated time-slot dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.constants import PEAK_HOURS, SLOT_MINUTES, TIME_DIM_END, TIME_DIM_START
from railyard.functions.timefmt import day_name, is_peak_hour, is_weekend


def time_dimension(bounds: DataFrame, minutes: int = SLOT_MINUTES, peak_hours=PEAK_HOURS) -> DataFrame:
    """Slots from ``start`` to ``end`` inclusive, ``minutes`` apart.

    ``bounds`` holds ``start``/``end`` timestamp_ntz columns (one row per
    range). The surrogate key is the slot's position in the range, so it is
    computed without a global ordering. The dimension is bounded by the range
    (96 rows per day at 15 minutes), never by the data volume.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    slots = bounds.select(F.posexplode(F.sequence(F.col("start"), F.col("end"), step)).alias("pos", "slot_ts"))
    ts = F.col("slot_ts")
    return slots.select(
        (F.col("pos") + 1).cast("int").alias("time_id"),
        ts.alias("slot_ts"),
        F.to_date(ts).alias("date"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        day_name(ts).alias("day_of_week"),
        F.hour(ts).alias("hour"),
        F.minute(ts).alias("minute"),
        is_peak_hour(ts, peak_hours).alias("is_peak_hour"),
        is_weekend(ts).alias("is_weekend"))


def time_dimension_between(spark: SparkSession, start: str = TIME_DIM_START, end: str = TIME_DIM_END,
                           minutes: int = SLOT_MINUTES) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("timestamp_ntz").alias("start"),
                                   F.lit(end).cast("timestamp_ntz").alias("end"))
    return time_dimension(bounds, minutes)


def slot_join(fact: DataFrame, dim_time: DataFrame, ts_col: str = "slot_ts") -> DataFrame:
    """Attach ``time_id`` by equality on the slot timestamp; rows without a slot drop out (see ``slot_misses``).

    Whether the dimension is broadcast is left to the planner, by its measured bytes.
    """
    dims = dim_time.select(F.col("slot_ts").alias("_slot"), "time_id")
    return fact.join(dims, F.col(ts_col) == F.col("_slot"), "inner").drop("_slot")


def slot_misses(fact: DataFrame, dim_time: DataFrame, ts_col: str = "slot_ts") -> DataFrame:
    """Rows whose slot the dimension does not hold."""
    dims = dim_time.select(F.col("slot_ts").alias("_slot"))
    return fact.join(dims, F.col(ts_col) == F.col("_slot"), "left_anti")
