"""Packing token sequences into as few windows as possible by linear grouping and best fit.

* Pieces: a document is its token ids and an end id. One that is longer than a
  window is cut into windows, of which the first holds what is left over.
* Lengths: all that the packing depends on is how many pieces there are of each
  length, at most ``capacity`` numbers, which come to the driver.
* Linear grouping: pieces longer than ``SMALL`` of a window are put in order of
  length into groups of equal size; each counts as long as its group's longest.
  So there are few sizes, and a linear programme over configurations (which
  sizes go into one window together) is solved by generating columns: the
  duals' best configuration is a small knapsack. Configurations are used a
  whole number of times.
* Substitution: places of a configuration are given actual pieces, the longest
  left that its group allows, and the last place the longest that fits, which
  takes back most of what rounding up has left empty.
* Best fit: what is left, longest first, goes where it leaves least room.
  Windows filled alike are handled together, so the plan's size depends on the
  capacity and not on the number of documents.
* Placement: pieces of one length are numbered (in buckets, as a length may be
  that of a third of all pieces) and meet the plan in a join on the length.

Defined cases: a null text counts as empty, and an empty one is one piece that
holds the end id alone; repeated rows are packed each; rows with null ids too.
Reruns place documents alike. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.llm.tables import documents, materialise, python_tasks

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END = 0
#: Pieces longer than this part of a window are grouped, into at most so many groups.
SMALL = 1 / 8
GROUPS = 192
#: The programme ends where no configuration is worth so much more than a window, or after so many steps a group.
ENOUGH, MOST_STEPS = 2e-4, 60
#: Pieces of one length that are numbered together.
BUCKET = 8192


def byte_of() -> dict[str, int]:
    """The byte for which each character of a byte-level vocabulary stands: printable ones for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of texts as little-endian 32-bit numbers.

    The vocabulary's merges are numbered like its tokens and every token is
    encoded as itself, so merging by the rank of the result, which a faster
    library does, gives the same ids (all code points are compared in a test).
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        tokenizer, alphabet = Tokenizer.from_file(path), byte_of()
        added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in tokenizer.get_vocab(with_added_tokens=False).items() if t not in added}
        library = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.plain = library.encode_ordinary
        self.added = added
        self.split = re.compile("(" + "|".join(map(re.escape, added)) + ")").split if added else None

    def encode(self, text: str) -> bytes:
        if self.split is None or not any(t in text for t in self.added):
            return array("I", self.plain(text)).tobytes()
        found = array("I")
        for k, part in enumerate(self.split(text)):
            found.extend([self.added[part]] if k % 2 else self.plain(part))
        return found.tobytes()


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, bytes]]:
    """Start and ids of each piece; the first holds what is left over."""
    n = len(ids) // 4
    start, end = 0, n % capacity or min(n, capacity)
    while start < n:
        yield start, ids[4 * start:4 * end]
        start, end = end, end + capacity


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of every piece of every document."""
    python_tasks(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    end = np.array([END], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        encoder = Encoder(str(public_tokenizers.path(vocabulary)))
        for batch in batches:
            rows, which, held = [], [], []
            for k, text in enumerate(batch.column("text")):
                for piece, (start, part) in enumerate(cut(encoder.encode(text.as_py()) + end, capacity)):
                    which.append(k)
                    rows.append((piece, start, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        held.append(part)
            at = np.array(rows, np.int64).reshape(-1, 4)
            columns = [batch.column("doc_id").take(pa.array(which, pa.int64())), pa.array(at[:, 0].astype(np.int32)),
                       *(pa.array(at[:, c]) for c in (1, 2, 3))]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(at[:, 2])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(held), "<i4"))))
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    return documents(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, schema)


class Place(NamedTuple):
    """``n`` pieces of one length, by their number from ``first`` on: ``each`` to a window from ``window`` on, at ``offset``."""

    length: int
    first: int
    n: int
    window: int
    each: int
    offset: int


class Group(NamedTuple):
    """Pieces that count as long as the longest of them."""

    longest: int
    shortest: int
    n: int


def grouped(counts: dict[int, int], most: int) -> list[Group]:
    """Groups of equal size (but the last), longest lengths first; those of the same longest length are one."""
    size = -(-sum(counts.values()) // most)
    groups: list[Group] = []
    for length in sorted(counts, reverse=True):
        n = counts[length]
        if groups and groups[-1].n < size:
            took = min(n, size - groups[-1].n)
            groups[-1] = Group(groups[-1].longest, length, groups[-1].n + took)
            n -= took
        if n:
            groups.append(Group(length, length, n))
    return groups


def best_configurations(sizes: np.ndarray, value: np.ndarray, capacity: int) -> np.ndarray:
    """For each size the configuration with it whose values add up to most: a knapsack by number of pieces."""
    use = np.flatnonzero(value > 1e-12)
    room = np.arange(capacity + 1)
    fits, at = room >= sizes[use][:, None], np.maximum(room - sizes[use][:, None], 0)
    best, taken = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min()) if len(use) else 0):
        score = np.where(fits, best[at] + value[use][:, None], -np.inf)
        top, pick = score.max(0), score.argmax(0)
        better = top > best + 1e-12
        if not better.any():
            break
        taken.append(np.where(better, use[pick], -1))
        best = np.where(better, top, best)
    out = np.eye(len(sizes), dtype=np.int64)
    for g, row in enumerate(out):
        left = capacity - int(sizes[g])
        for pick in reversed(taken):
            if pick[left] >= 0:
                row[pick[left]] += 1
                left -= int(sizes[pick[left]])
    return out


def configurations(sizes: np.ndarray, wanted: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each, rounded down: a linear programme whose columns are generated.

    Revised simplex method. A step takes the best column known so far; only
    where none helps are new ones sought, for which a knapsack is solved.
    """
    k = len(sizes)
    known = np.diag(capacity // sizes).astype(float)
    columns, cost = known.copy(), np.ones(k)
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ wanted
    for _ in range(MOST_STEPS * k):
        dual = cost @ inverse
        least = int(np.argmin(dual))
        if dual[least] < -1e-9:
            new, price = -np.eye(k)[least], 0.0  # a place of this size stays empty
        else:
            worth = known @ dual
            if worth.max() <= 1 + ENOUGH:
                found = best_configurations(sizes, dual, capacity)
                found = np.unique(found[found @ dual > 1 + ENOUGH], axis=0)
                if not len(found):
                    break
                known = np.concatenate([known, found])
                worth = known @ dual
            new, price = known[int(np.argmax(worth))], 1.0
        step = inverse @ new
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        x = np.maximum(x - ratio[out] * step, 0)
        x[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse = inverse - np.outer(step, row)
        inverse[out] = row
        columns[out], cost[out] = new, price
    return [(c.astype(np.int64), int(n + 1e-6)) for c, price, n in zip(columns, cost, x, strict=True) if price and int(n + 1e-6)]


class Filling:
    """A plan in the making: windows by the room left in them, and the pieces not yet placed."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.windows = capacity, 0
        self.places: list[Place] = []
        self.left = {length: n for length, n in counts.items() if n}
        self.lengths = sorted(self.left)
        self.given: dict[int, int] = defaultdict(int)
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: first window, how many
        self.rooms: list[int] = []

    def keep(self, room: int, window: int, n: int) -> None:
        if room and n:
            if not self.open[room]:
                self.rooms.insert(bisect_left(self.rooms, room), room)
            self.open[room].append((window, n))

    def place(self, length: int, n: int, window: int, each: int, offset: int) -> None:
        self.places.append(Place(length, self.given[length], n, window, each, offset))
        self.given[length] += n
        self.left[length] -= n
        if not self.left[length]:
            self.lengths.pop(bisect_left(self.lengths, length))

    def substitute(self, groups: list[Group], times: int) -> None:
        """``times`` windows of one configuration: each place gets the longest piece left that its group
        allows, the last place the longest for which there is room. A place for which none of its group
        is left stays empty."""
        todo = [(0, self.windows, times, 0)]
        self.windows += times
        while todo:
            k, window, n, used = todo.pop()
            if k == len(groups):
                self.keep(self.capacity - used, window, n)
                continue
            most = self.capacity - used if k == len(groups) - 1 else groups[k].longest
            while n:
                at = bisect_right(self.lengths, most) - 1
                if at < 0 or self.lengths[at] < groups[k].shortest:
                    todo.append((k + 1, window, n, used))
                    break
                length = self.lengths[at]
                took = min(n, self.left[length])
                self.place(length, took, window, 1, used)
                todo.append((k + 1, window, took, used + length))
                window, n = window + took, n - took

    def best_fit(self, length: int) -> None:
        """All that is left of one length, each where it leaves least room."""
        while n := self.left[length]:
            k = bisect_left(self.rooms, length)
            if k == len(self.rooms):
                fresh = max(1, n // (self.capacity // length))
                self.keep(self.capacity, self.windows, fresh)
                self.windows += fresh
                continue
            room = self.rooms[k]
            window, many = self.open[room].pop()
            if not self.open[room]:
                self.rooms.pop(k)
            each = min(room // length, n)
            took = min(many, n // each)
            self.place(length, took * each, window, each, self.capacity - room)
            self.keep(room - each * length, window, took)
            self.keep(room, window + took, many - took)


def plan(counts: dict[int, int], capacity: int = CAPACITY, most_groups: int = GROUPS) -> Filling:
    """Where pieces go, from the number of pieces of each length."""
    filling = Filling(counts, capacity)
    groups = grouped({length: n for length, n in filling.left.items() if length > SMALL * capacity}, most_groups)
    if groups:
        sizes, wanted = np.array([g.longest for g in groups]), np.array([g.n for g in groups], float)
        found = configurations(sizes, wanted, capacity)
        for configuration, times in sorted(found, key=lambda x: -int(x[0] @ sizes)):
            filling.substitute([groups[g] for g in np.repeat(np.arange(len(groups)), configuration)], times)
    for length in sorted(filling.left, reverse=True):
        filling.best_fit(length)
    return filling


def numbered(pieces: DataFrame, lengths: DataFrame) -> DataFrame:
    """With ``number``: 0, 1, 2 ... among the pieces of a length, counted in buckets of about ``BUCKET``."""
    dealt = pieces.join(lengths, "length").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.ceil(F.col("n_of_length") / BUCKET)))
    sums = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    begins = sums.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    within = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return dealt.withColumn("within", F.row_number().over(within)).join(begins, ["length", "bucket"]) \
        .withColumn("number", F.col("begin") + F.col("within") - 1).drop("bucket", "begin", "within", "n_of_length")


def place(pieces: DataFrame, capacity: int = CAPACITY, most_groups: int = GROUPS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a written table of pieces."""
    spark = pieces.sparkSession
    # At most ``capacity`` rows; the plan has a few for each length and configuration.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = plan(counts, capacity, most_groups).places
    lengths = spark.createDataFrame([(k, n) for k, n in counts.items()], "length long, n_of_length long")
    table = spark.createDataFrame([tuple(map(int, p)) for p in places], "length long, first long, n long, window long, each long, at long")
    j: Column = F.col("number") - F.col("first")
    rows = numbered(pieces, F.broadcast(lengths)).join(F.broadcast(table), "length").filter((j >= 0) & (j < F.col("n")))
    return rows.select(*pieces.columns, (F.col("window") + F.floor(j / F.col("each"))).alias("sequence_id"),
                       (F.col("at") + j % F.col("each") * F.col("length")).alias("offset"))


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) of every piece."""
    return place(materialise(token_pieces(docs, capacity, vocabulary, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the windows themselves, from pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
