"""Declared-constraint checks of the star schema as queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count (PK / UNIQUE)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per declared NOT NULL column with its null count (one scan, one aggregate)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, n_null)")


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row (foreign-key check)."""
    p = parent.select(F.col(parent_key).alias("_pk"))
    return child.join(p, F.col(child_key) == F.col("_pk"), "left_anti")


def fact_fk_orphans(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """``column_name, n_orphans`` per foreign key of a fact: rows whose value its dimension lacks (nulls refer to nothing)."""
    counts = [fk_orphans(fact.filter(F.col(c).isNotNull()).select(c), d, c, c)
              .agg(F.count(F.lit(1)).alias("n_orphans")).select(F.lit(c).alias("column_name"), "n_orphans")
              for c, d in dimensions.items()]
    return reduce(DataFrame.unionByName, counts)
