"""Session construction and the few cluster-facing helpers the operators share."""

from __future__ import annotations

import os
import sys
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "railyard") -> SparkSession:
    """Session for local runs and tests; on a cluster use the cluster's builder.

    AQE stays on (coalescing and skew-join splitting), the UI stays off and the
    session zone is UTC so timestamp text round-trips are stable.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; it is never overridden.
    Only a local master, whose executors are the driver's process, gets a
    temporary folder where it is unset; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="railyard-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/railyard-tables/{name}-{uuid.uuid4().hex[:12]}"


def debug(msg: str) -> None:
    """Loop progress on stderr when RAILYARD_DEBUG is set."""
    if os.environ.get("RAILYARD_DEBUG"):
        print(f"[railyard {time.strftime('%H:%M:%S')}] {msg}", file=sys.stderr, flush=True)


def write_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This is how iterative jobs cut lineage and plan growth each round: the
    returned frame's plan is a file scan (declared schema, so empty results
    read back too), it survives executor loss, and the write is one job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_table_metrics(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, dict]:
    """``write_table`` that also returns aggregates of the rows, taken by the same job."""
    from pyspark.sql import Observation
    seen = Observation(f"railyard_{name.replace('-', '_')}_{uuid.uuid4().hex[:8]}")
    table = write_table(df.observe(seen, *[m.alias(k) for k, m in metrics.items()]), name)
    return table, dict(seen.get)


def write_table_observed(df: DataFrame, name: str, metric=None) -> tuple[DataFrame, int]:
    """``write_table`` that also returns an aggregate (default: row count) computed by the same job.

    The metric is collected with ``DataFrame.observe``, so a loop learns the
    size of its new state without a second pass over it.
    """
    from pyspark.sql import Observation
    spark = df.sparkSession
    obs = Observation(f"railyard_{name.replace('-', '_')}_{uuid.uuid4().hex[:8]}")
    metric = F.count(F.lit(1)) if metric is None else metric
    path = scratch_path(spark, name)
    df.observe(obs, metric.alias("m")).write.mode("overwrite").parquet(path)
    value = obs.get.get("m")
    return spark.read.schema(df.schema).parquet(path), int(value or 0)


def drop_table(df: DataFrame) -> None:
    """Delete the folder of a table that ``write_table`` made and nothing reads any more."""
    spark = df.sparkSession
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/railyard-tables")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.makeQualified(path).toString().startswith(files.makeQualified(base).toString()):
            files.delete(path, True)
