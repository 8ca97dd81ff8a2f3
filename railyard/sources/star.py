"""The star schema as typed Parquet tables: write, read, replace a dimension, update the fact.

Every table is written with its declared types; rows that break a NOT NULL or
the key of their table end the write with the checks' findings. Tables live in
versioned folders behind one manifest (``versions.py``); the fact is divided by
planned date. So a dimension and the fact that depends on it change together
or not at all, and a change writes only the dates that it touches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard import schemas
from railyard.operators.merge import update_merge_coalesce
from railyard.session import drop_table, write_table, write_table_metrics
from railyard.sources.versions import PART, WHOLE, Versions

TABLES = {
    "dim_station": (schemas.DIM_STATION, ("station_id",)),
    "dim_time": (schemas.DIM_TIME, ("time_id",)),
    "dim_train": (schemas.DIM_TRAIN, ("train_id",)),
    "fact_train_movement": (schemas.FACT_MOVEMENT, schemas.FACT_UNIQUE_KEY),
}
#: The fact's foreign keys: dimension and column.
REFERENCES = {"dim_station": "station_id", "dim_time": "time_id", "dim_train": "train_id"}
FACT = "fact_train_movement"
#: What a change names a stop event by; all its snapshot rows change.
EVENT_KEY = ("station_id", "stop_id", "is_arrival")
# Slices of the keys, of which one is looked up for itself, and files up to which a change is written as it lies.
SLICES, MOST_FILES = 64, 20_000


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in their declared types; columns that are missing are null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def planned_part(grain: str) -> Column:
    """What divides the fact into parts: the planned day, or the first day of its week, month, quarter or year."""
    day = F.to_date("planned_time")
    return day if grain == "DAY" else F.trunc(day, grain)


def grain_of(store: Versions) -> str:
    return store.current()["notes"].get("grain", "DAY")


def repeated_keys(rows: DataFrame, key: tuple[str, ...]) -> int:
    """How many keys rows share. Hashes of 64 bits are counted; only if some meet are the keys themselves."""
    def shared(by: list[Column]) -> int:
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").count()

    return shared([F.col(c) for c in key]) if shared([F.xxhash64(*key).alias("h")]) else 0


def checked(df: DataFrame, name: str) -> DataFrame:
    """The table's rows, typed and written aside, if they keep its rules.

    Nulls are counted while the rows are written; the key is counted on its columns alone.
    """
    schema, key = TABLES[name]
    required = [f.name for f in schema.fields if not f.nullable]
    new, nulls = write_table_metrics(typed(df, schema), f"star-{name}", **{c: F.count_if(F.col(c).isNull()) for c in required})
    missing = [c for c in required if nulls[c]]
    repeated = repeated_keys(new, key)
    if missing or repeated:
        drop_table(new)
        raise ValueError(f"{name}: nulls in {missing}, {repeated} repeated keys")
    return new


def write_checked(df: DataFrame, store: Versions, name: str, part: Column | None = None, gather: bool = True) -> dict[str, str]:
    """New folders of the store with the table's rows, typed, if they keep its rules; they are dropped if not.

    Nulls are counted while the rows are written; the key is counted on the written columns.
    """
    schema, key = TABLES[name]
    required = [f.name for f in schema.fields if not f.nullable]
    seen = Observation(f"railyard_star_{uuid.uuid4().hex[:8]}")
    folders = store.write(name, typed(df, schema).observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in required]), part, gather)
    nulls = seen.get
    missing = [c for c in required if nulls[c]]
    repeated = repeated_keys(store.read_folders(folders.values(), schema), key)
    if missing or repeated:
        store.drop_written(folders.values())
        raise ValueError(f"{name}: nulls in {missing}, {repeated} repeated keys")
    return folders


def write_star_table(df: DataFrame, root: str, name: str, grain: str = "DAY") -> DataFrame:
    """Write one table of the schema under ``root`` in place of what is there, and read it back.

    The fact is divided by planned day, or by a longer ``grain`` where it spans very many days; parts are then so
    few that each task writes its own file of each.
    """
    store = Versions(df.sparkSession, root)
    folders = write_checked(df, store, name, planned_part(grain) if name == FACT else None, gather=grain == "DAY")
    store.commit({name: folders}, replace=[name], notes={"grain": grain} if name == FACT else None)
    return read_star_table(df.sparkSession, root, name)


def read_star_table(spark: SparkSession, root: str, name: str, dates: list[str] | None = None) -> DataFrame:
    """A table; of the fact only the parts of some planned dates (``yyyy-MM-dd``), if wanted."""
    return Versions(spark, root).read(name, TABLES[name][0], dates)


def _parts_of(fact: DataFrame, store: Versions) -> list[str]:
    """The parts that these rows of the fact are in: at most one value per part of the fact."""
    part = F.coalesce(planned_part(grain_of(store)).cast("string"), F.lit(WHOLE)).alias(PART)
    return sorted(r[PART] for r in fact.select(part).distinct().collect())


def _rewrite(store: Versions, parts: list[str], rows: DataFrame) -> tuple[dict[str, str], list[str]]:
    """New folders for some parts of the fact, and those of them that are left without rows."""
    tasks = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    written = store.write(FACT, rows, planned_part(grain_of(store)), gather=len(parts) * tasks > MOST_FILES) if parts else {}
    return written, [p for p in parts if p not in written]


def replace_dimension(df: DataFrame, root: str, name: str) -> DataFrame:
    """Replace a dimension, and with it the dates of the fact that have rows it no longer holds; returns those rows."""
    spark, column = df.sparkSession, REFERENCES[name]
    store = Versions(spark, root)
    before = store.current()["number"]
    new = checked(df, name)
    fact = read_star_table(spark, root, FACT)
    lost = write_table(fact.join(new.select(column), column, "left_anti").select(fact.columns), "star-lost")
    parts = _parts_of(lost, store)
    kept = store.read(FACT, TABLES[FACT][0], parts).join(new.select(column), column, "left_semi").select(fact.columns)
    written, gone = _rewrite(store, parts, kept)
    store.commit({name: store.write(name, new), FACT: written}, replace=[name], gone={FACT: gone}, on=before)
    drop_table(new)
    return lost


def _touched_parts(store: Versions, updates: DataFrame, keys: list[str]) -> list[str]:
    """The parts that hold rows of changed stop events.

    One slice of the keys finds most parts where changes are many; those that it does not are looked up by all keys.
    """
    here = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(SLICES)) == 0
    changed = updates.select(*keys).distinct()
    stored = lambda parts=None: store.read(FACT, TABLES[FACT][0], parts).select(*keys, "planned_time")
    found = _parts_of(stored().filter(here).join(changed.filter(here), keys, "left_semi"), store)
    rest = sorted(set(store.parts(FACT)) - set(found))
    return sorted(found + _parts_of(stored(rest).join(changed, keys, "left_semi"), store)) if rest else found


def update_fact(spark: SparkSession, root: str, updates: DataFrame, order: list[str]) -> list[str]:
    """Apply changes to the stored fact; returns the parts (dates) that were written.

    ``updates``: ``station_id, stop_id, is_arrival, ct, cp, cs, clt`` and the order
    columns; they are read for the lookups and for the merge, so give a written
    table where they are costly or not the same each time. The dates that hold rows
    of changed stop events are found from the key columns; only those are read whole,
    merged and written.
    """
    store, keys = Versions(spark, root), list(EVENT_KEY)
    before = store.current()["number"]
    updates = updates.select(*keys, "ct", "cp", "cs", "clt", *[c for c in order if c not in keys])
    parts = _touched_parts(store, updates, keys)
    if parts:
        now = store.read(FACT, TABLES[FACT][0], parts)
        merged = update_merge_coalesce(now, updates, keys, order)
        written, gone = _rewrite(store, parts, typed(merged, TABLES[FACT][0]))
        store.commit({FACT: written}, gone={FACT: gone}, on=before)
    return parts
