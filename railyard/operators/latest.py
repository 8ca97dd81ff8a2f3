"""Latest / first row per key (W1, A7, A9) as aggregates, not windows.

``max_by(struct(row), struct(order))`` combines map-side (partial aggregate
before the shuffle), so a key holding a third of all rows costs one buffer per
task instead of one sorted partition, as ``row_number() = 1`` would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool) -> DataFrame:
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c) for c in order])
    row = F.struct(*[F.col(c) for c in payload])
    agg = F.max_by(row, by) if latest else F.min_by(row, by)
    return df.groupBy(*keys).agg(agg.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (rows with a null order struct never win)."""
    return _pick(df, keys, order, latest=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` (insert-if-absent, first wins)."""
    return _pick(df, keys, order, latest=False)
