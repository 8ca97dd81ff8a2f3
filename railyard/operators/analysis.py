"""Reporting queries of the warehouse (parametrised SQL part) and of the Parquet analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.constants import PEAK_HOURS
from railyard.functions.timefmt import is_peak_hour
from railyard.operators.latest import latest_per_key


# --- warehouse queries ------------------------------------------------------

def station_lookup(stations: DataFrame, station_name: str) -> DataFrame:
    """Identifier and coordinates of every station with this exact name."""
    return (stations.filter(F.col("station_name") == F.lit(station_name))
            .select("station_id", "station_name", "latitude", "longitude"))


def distance_score(lat, lon, point_lat, point_lon):
    return F.pow(lat - point_lat, 2) + F.pow(lon - point_lon, 2)


def nearest_station(stations: DataFrame, lat: float, lon: float) -> DataFrame:
    """Closest station by squared Euclidean distance on (lat, lon); ties -> smaller id.

    ``orderBy(...).limit(1)`` plans as TakeOrderedAndProject: a per-task top-1
    then a merge, never a full sort.
    """
    score = distance_score(F.col("latitude"), F.col("longitude"), F.lit(lat), F.lit(lon))
    return (stations.select("station_id", "station_name", "latitude", "longitude",
                            score.alias("distance_score"))
            .orderBy("distance_score", "station_id").limit(1)
            .select("station_name", "latitude", "longitude", "distance_score"))


def cancellations_at_hour(fact: DataFrame, dim_time: DataFrame, date: str, hour: int) -> DataFrame:
    """Cancelled movement rows whose snapshot slot lies in (date, hour)."""
    slots = dim_time.filter((F.col("date") == F.lit(date).cast("date")) & (F.col("hour") == F.lit(hour)))
    # The slot filter leaves at most 60/step rows: a proven-small broadcast side.
    joined = fact.filter(F.col("is_canceled")).join(F.broadcast(slots.select("time_id")), "time_id")
    return joined.agg(F.count(F.lit(1)).alias("total_canceled_trains"))


def latest_arrival_delay(fact: DataFrame, stations: DataFrame, station_name: str,
                         order_cols=("time_id",)) -> DataFrame:
    """Mean clamped delay of the latest snapshot of each arrival at the named station.

    The latest row is chosen first; a latest row with null delay then drops
    out of the mean (it does not fall back to an older snapshot).
    """
    ids = stations.filter(F.col("station_name") == F.lit(station_name)).select("station_id")
    arrivals = (fact.filter(F.col("is_arrival"))
                .join(ids, "station_id")
                .select("station_id", "stop_id", "is_arrival", "delay_minutes", *order_cols))
    latest = latest_per_key(arrivals, ["station_id", "stop_id", "is_arrival"], list(order_cols))
    return (latest.filter(F.col("delay_minutes").isNotNull())
            .agg(F.avg(F.greatest(F.lit(0), F.col("delay_minutes"))).alias("avg_delay_minutes")))


# --- Parquet analyses ---------------------------------------------------------

def daily_avg_delay(events: DataFrame, station_name: str) -> DataFrame:
    """Mean delay per event date for one station, cancelled rows excluded, by date."""
    return (events.filter((F.col("station_name") == F.lit(station_name)) & (~F.col("is_canceled")))
            .groupBy("event_date")
            .agg(F.avg("delay_minutes").alias("avg_daily_delay"))
            .orderBy("event_date"))


def peak_departures_daily(events: DataFrame, peak_hours=PEAK_HOURS) -> DataFrame:
    """Departures in peak hours of the planned time, counted per (station, date)."""
    return (events.filter((~F.col("is_arrival")) & is_peak_hour("planned_time", peak_hours))
            .groupBy("station_name", "event_date")
            .agg(F.count(F.lit(1)).alias("daily_peak_departures")))


def peak_departures(events: DataFrame, peak_hours=PEAK_HOURS) -> DataFrame:
    """Mean over dates (with at least one) of the daily peak departures, per station."""
    return (peak_departures_daily(events, peak_hours)
            .groupBy("station_name")
            .agg(F.avg("daily_peak_departures").alias("avg_peak_departures"))
            .orderBy(F.col("avg_peak_departures").desc(), F.col("station_name")))


def peak_departures_top(events: DataFrame, k: int = 10, peak_hours=PEAK_HOURS) -> DataFrame:
    """Top-k stations by mean peak departures (ties by name): the report's limit is the feature."""
    return peak_departures(events, peak_hours).limit(k)
