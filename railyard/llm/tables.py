"""Reading the given tables and writing intermediate ones for the operators of this subpackage."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import railyard
from railyard.session import write_table

#: ASCII white space that separates words in every operator here, as the inside of a regular expression's class.
SPACE = r"\x20\x09-\x0D"

#: Bounds of one Arrow batch handed to Python. Texts are long, so the defaults would hold too many bytes at once.
ARROW_BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2_000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}
#: The same for functions that take whole texts apart: strings, words and ids of a batch take some ten times its bytes, and
#: executor and worker each hold a few copies of it.
TEXT_BATCH = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *extra: str) -> DataFrame:
    """Only ``doc_id``, ``text`` and the named columns, so that other columns of any name cannot clash."""
    return df.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)


def python_tasks(spark: SparkSession, batch_bytes: int | None = None) -> None:
    """Get the session ready for Python functions in tasks.

    Bounds the rows and bytes of an Arrow batch, unless the session already
    asks for less, and sends this library to the workers (once per context),
    which need not have it installed. ``batch_bytes`` is a smaller bound.
    """
    context = spark.sparkContext
    if not getattr(context, "railyard_sent", False):
        package = Path(railyard.__file__).parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='railyard-code-')}/railyard_code", "zip", package.parent, package.name)
        context.addPyFile(archive)
        context.railyard_sent = True
    bounds = ARROW_BOUNDS | ({"spark.sql.execution.arrow.maxBytesPerBatch": batch_bytes} if batch_bytes else {})
    for key, most in bounds.items():
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` into the cluster's shared checkpoint folder and read it back."""
    return write_table(df, f"llm-{name}")


def words(text: Column) -> Column:
    """Number of words of a text, null counting as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))
