"""Station-name normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.constants import NAME_OVERRIDES, NAME_PREFIX


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_prefix(col, prefix: str = NAME_PREFIX) -> Column:
    """Remove ``prefix`` and trim when present; empty text -> null."""
    c = F.nullif(_c(col), F.lit(""))
    stripped = F.trim(c.substr(F.lit(len(prefix) + 1), F.length(c)))
    return F.when(c.startswith(prefix), stripped).otherwise(c)


def overrides_frame(spark: SparkSession, overrides: dict[str, str] | None = None) -> DataFrame:
    """Override map as a two-column DataFrame (raw_name, override_name)."""
    rows = sorted((overrides if overrides is not None else NAME_OVERRIDES).items())
    return spark.createDataFrame(rows, "raw_name string, override_name string")


def normalize_names(names: DataFrame, name_col: str, overrides: DataFrame,
                    prefix: str = NAME_PREFIX, out_col: str = "normalized") -> DataFrame:
    """Spark-path normalisation: override, else prefix strip, else unchanged."""
    ov = overrides.withColumnRenamed("raw_name", "_ov_raw")
    joined = names.join(ov, F.col(name_col) == F.col("_ov_raw"), "left")
    value = F.when(F.nullif(F.col(name_col), F.lit("")).isNull(), F.lit(None).cast("string")) \
        .otherwise(F.coalesce(F.col("override_name"), strip_prefix(name_col, prefix)))
    return joined.withColumn(out_col, value).drop("_ov_raw", "override_name")
