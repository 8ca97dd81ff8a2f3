"""Movement Parquet partitioned by event date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.schemas import MOVEMENT_EVENT
from railyard.session import scratch_path

# Bounds output file size whatever the skew of one date.
MAX_RECORDS_PER_FILE = 5_000_000


def write_movement_events(df: DataFrame, path: str | None = None, mode: str = "overwrite") -> str:
    """Write rows with a date to ``path`` partitioned by ``event_date``; return the path.

    With no path the table goes to a fresh folder under the shared checkpoint
    folder (``spark.checkpoint.dir``). ``mode="overwrite"`` together with
    ``spark.sql.sources.partitionOverwriteMode=dynamic`` replaces only the dates
    present in ``df`` (in-place update of affected partitions).
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "movement_event")
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in MOVEMENT_EVENT.fields]
    # Rebalanced by date: small dates share a task and a file each, large ones are split.
    (df.select(*cols).filter(F.col("event_date").isNotNull()).hint("rebalance", "event_date")
       .write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy("event_date").parquet(path))
    return path


def overwrite_dates(df: DataFrame, path: str) -> str:
    """Replace only the ``event_date`` partitions present in ``df`` (dynamic partition overwrite)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in MOVEMENT_EVENT.fields]
    (df.select(*cols).filter(F.col("event_date").isNotNull()).hint("rebalance", "event_date")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("event_date").parquet(path))
    return path


def read_movement_events(spark: SparkSession, path: str, date_from: str | None = None,
                         date_to: str | None = None) -> DataFrame:
    """Read the partitioned table with its declared schema; date bounds prune partitions."""
    df = spark.read.schema(MOVEMENT_EVENT).parquet(path)
    if date_from is not None:
        df = df.filter(F.col("event_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.filter(F.col("event_date") <= F.lit(date_to).cast("date"))
    return df
