"""Tables in versioned folders behind one manifest, so that several change together or not at all.

A table has parts, each in a folder of its own that is never written again. A
manifest names the folders that hold the current parts of every table under a
root. A change writes the folders of the parts that change and then one new
manifest, which is written aside and put in place by a rename that fails if
that manifest is there already: readers see all of a change or nothing, a
failure in between leaves what was there, and of two writers one fails.

A part is named by a value of a column that comes with the rows (a date, a
bucket); there must be few enough for a manifest to list. ``drop_old`` deletes
folders that the current manifest does not name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifests"
PART = "part_of_table"
# The part of a table that is not divided, and of rows without a value.
WHOLE = "all"


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        path = self._path(self.root)
        self.files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/{MANIFESTS}")
        if not self.files.exists(folder):
            return []
        names = [f.getPath().getName() for f in self.files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def current(self) -> dict:
        """``tables``: parts and their folders; ``notes``: what writers keep with them; ``number`` of the manifest."""
        numbers = self._numbers()
        if not numbers:
            return {"tables": {}, "notes": {}, "number": 0}
        text = self.spark.read.text(f"{self.root}/{MANIFESTS}/{numbers[-1]:012d}.json", wholetext=True).first().value
        return json.loads(text) | {"number": numbers[-1]}

    def parts(self, name: str) -> dict[str, str]:
        return self.current()["tables"].get(name, {})

    def read(self, name: str, schema: T.StructType, only: Iterable[str] | None = None, missing_ok: bool = False) -> DataFrame:
        """A table, or only some of its parts (those that exist)."""
        parts = self.parts(name)
        if not parts and not missing_ok:
            raise FileNotFoundError(f"no table {name} under {self.root}")
        wanted = sorted(parts) if only is None else sorted(set(only) & set(parts))
        return self.read_folders([parts[p] for p in wanted], schema)

    def read_folders(self, folders: Iterable[str], schema: T.StructType) -> DataFrame:
        """The rows of written parts, referred to or not."""
        paths = [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def drop_written(self, folders: Iterable[str]) -> None:
        """Delete parts that were written and will not be committed."""
        for folder in folders:
            self.files.delete(self._path(f"{self.root}/{folder}"), True)

    def write(self, name: str, rows: DataFrame, part: Column | None = None, gather: bool = True) -> dict[str, str]:
        """Write rows into new folders, one per value of ``part``; nothing refers to them until ``commit``.

        Without ``gather`` every task writes a file for each part that it has rows of, which saves a shuffle of all rows.
        """
        folder = f"{name}/{uuid.uuid4().hex[:12]}"
        if part is None:
            rows.write.option("compression", "zstd").parquet(f"{self.root}/{folder}/{PART}={WHOLE}")
            return {WHOLE: f"{folder}/{PART}={WHOLE}"}
        divided = rows.withColumn(PART, F.coalesce(part.cast("string"), F.lit(WHOLE)))
        # Rebalanced by part: small parts share a task and have a file each, large ones are split.
        divided = divided.hint("rebalance", PART) if gather else divided
        divided.write.option("compression", "zstd").partitionBy(PART).parquet(f"{self.root}/{folder}")
        names = [f.getPath().getName() for f in self.files.listStatus(self._path(f"{self.root}/{folder}")) if f.isDirectory()]
        return {n.removeprefix(f"{PART}="): f"{folder}/{n}" for n in names if n.startswith(f"{PART}=")}

    def commit(self, tables: dict[str, dict[str, str]], replace: Iterable[str] = (), gone: dict[str, Iterable[str]] | None = None,
               notes: dict | None = None, on: int | None = None) -> int:
        """Put written parts in place, all at once; returns the manifest's number.

        Parts of a table in ``replace`` that are not written again are dropped, as
        are those in ``gone``; others stay. ``on`` is the number of the manifest
        from which the change was made: if there is a newer one the change fails.
        """
        now = self.current()
        if on is not None and on != now["number"]:
            raise RuntimeError(f"{self.root} has changed meanwhile (manifest {now['number']}, not {on})")
        for name, parts in tables.items():
            old = {} if name in replace else now["tables"].get(name, {})
            now["tables"][name] = {p: f for p, f in old.items() if p not in set((gone or {}).get(name, ()))} | parts
        number = now.pop("number") + 1
        now["notes"] |= notes or {}
        aside, place = self._path(f"{self.root}/{MANIFESTS}/{uuid.uuid4().hex}.new"), self._path(f"{self.root}/{MANIFESTS}/{number:012d}.json")
        out = self.files.create(aside, False)
        out.write(bytearray(json.dumps(now, sort_keys=True).encode()))
        out.close()
        if self.files.exists(place) or not self.files.rename(aside, place):
            self.files.delete(aside, False)
            raise RuntimeError(f"{self.root} has changed meanwhile (manifest {number} is there)")
        return number

    def drop_old(self) -> int:
        """Delete folders that the current manifest does not name (of changes that failed, or that later ones replaced)."""
        kept = {f for parts in self.current()["tables"].values() for f in parts.values()}
        dropped = 0
        for name in self.current()["tables"]:
            for version in self.files.listStatus(self._path(f"{self.root}/{name}")):
                for part in self.files.listStatus(version.getPath()):
                    if f"{name}/{version.getPath().getName()}/{part.getPath().getName()}" not in kept and part.isDirectory():
                        dropped += bool(self.files.delete(part.getPath(), True))
        return dropped
