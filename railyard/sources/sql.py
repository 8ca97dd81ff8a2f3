"""Parametrised SQL text -> DataFrame.

SQL files use ``:name`` markers; Spark binds them as literals (no string
splicing), comments and a trailing ``;`` are accepted by the parser.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, sql_text: str, params: Mapping[str, object] | None = None,
            frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run ``sql_text`` with named parameters; the ``frames`` are tables of that name for this statement only.

    Frames are registered under names that nobody else uses and given theirs
    by common table expressions around the statement, so neither the caller's
    views nor statements of other threads see them.
    """
    text, own = sql_text.strip().rstrip(";"), {name: f"frame_{uuid.uuid4().hex}" for name in frames or {}}
    if own:
        tables = ", ".join(f"`{name}` AS (SELECT * FROM {view})" for name, view in own.items())
        text = f"WITH {tables} SELECT * FROM (\n{text}\n)"
    try:
        for name, view in own.items():
            frames[name].createOrReplaceTempView(view)
        return spark.sql(text, args=dict(params or {}))  # names are resolved here, so the views may go
    finally:
        for view in own.values():
            spark.catalog.dropTempView(view)


def run_sql_file(spark: SparkSession, path: str, params: Mapping[str, object] | None = None,
                 frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
    return run_sql(spark, Path(path).read_text(encoding="utf-8"), params, frames)
