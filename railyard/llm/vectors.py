"""Approximate nearest neighbours by inner product over balanced posting lists.

The largest inner product is the smallest Euclidean distance once every vector
gets one more component that brings it to the largest norm (a query's is 0).

* Fitting: a bounded sample (``FIT_ROWS`` rows by a digest of the id) is split
  into clusters by k-means, the large ones again, until none is much larger
  than the rest. Their number follows the table up to ``MAX_LISTS``, so the
  centroids and their neighbour graph fit in memory and are broadcast.
* Lists: every row goes into the list of its closest centroid (its distances to
  all of them are one matrix product). Vectors near a
  boundary are also put into the lists of other centroids that are almost as
  close, unless such a centroid is closer to one already chosen.
* Searching: a query walks the graph to the closest centroids and from there on
  over neighbours, as long as they are within a ratio of the closest one's
  distance; it reads the lists of all that it finds so. As the closest distance
  may be near 0, the ratio applies to the last of the ``LEAST_LISTS`` closest lists
  that have rows, or of as many as surely hold the wanted number of candidates.
* Lists are searched in groups: rows and queries of a group are dealt out in
  blocks, so neither a crowded list nor a list that many queries read is one
  task. A block scores its queries against its rows in matrix products, keeps
  what the queries' own lists hold, and returns each query's nearest few, once
  for all its lists; the nearest of all blocks are kept.

Scores are inner products of the original vectors in double precision, added
up in the same order for every row, so equal vectors tie exactly.

Defined cases: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, nor do rows with a null id;
of rows repeating an id the smallest vector counts; ties go to the smaller id;
with fewer candidates than wanted all are returned; an empty table gives an
empty result. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.llm.tables import materialise, python_tasks

FIT_ROWS = 20_000
LIST_ROWS = 256
MAX_LISTS = 8192
#: Neighbours of a centroid in the graph: those it would find as a query, and those of its direction.
FOUND, ALIKE = 16, 8
#: Centroids that a walk keeps, and those of them whose neighbours it looks at.
BEAM, EXPAND = 64, 16
#: A vector goes into further lists, and a query reads further lists, within these ratios of the closest distance.
BOUNDARY, PROBE = 1.10, 1.15
REPLICAS = 4
#: Lists that a query reads at least.
LEAST_LISTS = 4
#: Rows of a frame of dealt vectors.
FRAME = 16_384
#: Lists of a group; rows and queries of a block of it, and queries scored at once.
GROUP_LISTS = 256
ROW_BLOCK, QUERY_BLOCK, AT_ONCE = 32_768, 1024, 64
RESULT = "query_id long, rank int, vec_id long, score double"


def usable(table: DataFrame) -> DataFrame:
    """``vec_id, v``: one usable vector per id."""
    v = F.col("embedding").cast("array<double>")
    rows = table.select("vec_id", v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()) \
        .filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


class Lists(NamedTuple):
    """Centroids (in one more dimension) with their neighbour graph; at most ``MAX_LISTS`` of them."""

    centroids: np.ndarray
    graph: np.ndarray
    norm: float

    def lifted(self, v: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.norm ** 2 - (v * v).sum(1), 0))
        return np.column_stack([v, rest])

    def walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the closest centroids found and their distances, closest first, by a walk of the graph from spread entries."""
        n, beam = len(self.centroids), min(BEAM, len(self.centroids))
        entry = np.unique(np.linspace(0, n - 1, beam).astype(np.int64))
        at = np.broadcast_to(entry, (len(x), len(entry)))
        d = self.distance(x, at)
        while True:
            near = self.graph[at[:, :EXPAND]].reshape(len(x), -1)
            both, dist = np.concatenate([at, near], 1), np.concatenate([d, self.distance(x, near)], 1)
            order = np.lexsort((both, dist), axis=1)
            both, dist = np.take_along_axis(both, order, 1), np.take_along_axis(dist, order, 1)
            dist[:, 1:][both[:, 1:] == both[:, :-1]] = np.inf
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            new, d = np.take_along_axis(both, order, 1), np.take_along_axis(dist, order, 1)
            if new.shape == at.shape and (new[:, :EXPAND] == at[:, :EXPAND]).all():
                return new, d
            at = new

    def distance(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        c = self.centroids
        sq = (x * x).sum(1)[:, None] + (c * c).sum(1)[at] - 2 * np.einsum("nd,nkd->nk", x, c[at])
        return np.sqrt(np.maximum(sq, 0))

    def closest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row its closest centroids and their distances, closest first, from the distances to all."""
        c, beam = self.centroids, min(BEAM, len(self.centroids))
        d = (c * c).sum(1) - 2 * x @ c.T
        at = np.argpartition(d, beam - 1, axis=1)[:, :beam]
        at = np.take_along_axis(at, np.lexsort((at, np.take_along_axis(d, at, 1)), axis=1), 1)
        return at, np.sqrt(np.maximum((x * x).sum(1)[:, None] + np.take_along_axis(d, at, 1), 0))

    def homes(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists that each vector goes into."""
        at, d = self.closest(x)
        every, place = np.arange(len(x)), np.zeros(len(x), np.int64)
        chosen, apart, open_rows = [at[:, 0]], np.full(at.shape, np.inf), np.ones(len(x), bool)
        for _ in range(REPLICAS - 1):
            last = self.centroids[chosen[-1]]
            apart = np.minimum(apart, np.sqrt(np.square(self.centroids[at] - last[:, None]).sum(2)))
            may = (d <= BOUNDARY * d[:, :1]) & (apart >= d) & (np.arange(at.shape[1]) > place[:, None]) & open_rows[:, None]
            open_rows = may.any(1)
            if not open_rows.any():
                break
            place = np.where(open_rows, may.argmax(1), place)
            chosen.append(at[every, place])
        # Rows that were full before repeat their last list.
        return [np.array(list(dict.fromkeys(row))) for row in zip(*chosen, strict=True)]

    def probes(self, x: np.ndarray, sizes: np.ndarray, wanted: int) -> list[np.ndarray]:
        """The lists that each query reads; ``sizes`` are the rows of all lists, at least one of which has some."""
        n, used = len(self.centroids), np.flatnonzero(sizes)
        dist = np.full((len(x), n), np.inf)
        at, d = self.walk(x)
        np.put_along_axis(dist, at, d, 1)
        # A row is in up to REPLICAS lists, and one candidate may be the query itself.
        enough = REPLICAS * (wanted + 1)
        done = np.zeros((len(x), n), bool)
        while True:
            order = np.argsort(dist[:, used], axis=1, kind="stable")
            short = (sizes[used][order].cumsum(1) < enough).sum(1)
            floor = np.minimum(np.maximum(short, LEAST_LISTS - 1), len(used) - 1)
            last = np.take_along_axis(dist[:, used], order[np.arange(len(x)), floor][:, None], 1)  # infinite as long as too few are found
            within = dist <= PROBE * last + 1e-12
            q, c = np.nonzero(within & ~done & np.isfinite(dist))
            if not len(q):
                return [used[(row <= PROBE * most + 1e-12)[used]] for row, most in zip(dist, last[:, 0], strict=True)]
            done[q, c] = True
            key = np.unique((q[:, None] * n + self.graph[c]).ravel())
            q, c = key // n, key % n
            new = np.isinf(dist[q, c])
            q, c = q[new], c[new]
            dist[q, c] = np.sqrt(np.maximum((x[q] * x[q]).sum(1) + (self.centroids[c] ** 2).sum(1) - 2 * (x[q] * self.centroids[c]).sum(1), 0))


def k_means(x: np.ndarray, k: int, r: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """The cluster of each row."""
    centres = x[r.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        of = np.argmin((centres * centres).sum(1) - 2 * x @ centres.T, 1)
        for c in range(k):
            if (own := of == c).any():
                centres[c] = x[own].mean(0)
    return of


def fit(sample: np.ndarray, norm: float, n_rows: int) -> Lists:
    """Clusters of the sample, split until none is larger than its share of a list, and the graph of their centroids."""
    r = np.random.default_rng(7)
    blank = Lists(np.zeros((0, 0)), np.zeros((0, 0), np.int64), norm)
    x = blank.lifted(sample, query=False)
    n_lists = max(1, min(MAX_LISTS, -(-n_rows // LIST_ROWS), len(x)))
    most = max(1.0, 1.3 * len(x) / n_lists)
    todo, done = [x], []
    while todo:
        part = todo.pop()
        if len(part) <= most or (part == part[0]).all():
            done.append(part.mean(0))
            continue
        of = k_means(part, min(16, max(2, round(len(part) / most))), r)
        if (of == of[0]).all():
            of = np.arange(len(part)) % 2
        todo += [part[of == c] for c in np.unique(of)]
    c = np.array(done)
    sq = (c * c).sum(1)
    short = np.maximum(np.linalg.norm(c[:, :-1], axis=1, keepdims=True), 1e-30)
    turned = c[:, :-1] / short
    graph = np.empty((len(c), FOUND + ALIKE + 1), np.int64)
    for k in range(0, len(c), 1024):
        part = slice(k, k + 1024)
        found = np.argsort(sq[None] - 2 * c[part, :-1] @ c[:, :-1].T, 1, kind="stable")[:, :FOUND]
        alike = np.argsort(-(turned[part] @ turned.T), 1, kind="stable")[:, :ALIKE]
        graph[part, :FOUND] = found[:, np.arange(FOUND) % found.shape[1]]
        graph[part, FOUND:-1] = alike[:, np.arange(ALIKE) % alike.shape[1]]
    graph[:, -1] = (np.arange(len(c)) + 1) % len(c)  # a ring, so that every centroid can be reached
    return Lists(c, graph, norm)


def dealt(table: DataFrame, lists, method: str, query: bool, *args) -> DataFrame:
    """``vec_id, v, list``: a row for each list of a vector."""

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), 256):
                f = frame.iloc[k:k + 256]
                of = getattr(lists.value, method)(lists.value.lifted(np.stack(f["v"].to_list()), query), *args)
                every, into = np.repeat(np.arange(len(f)), [len(x) for x in of]), np.concatenate(of)
                for j in range(0, len(every), FRAME):
                    at = every[j:j + FRAME]
                    yield pd.DataFrame({"vec_id": f["vec_id"].to_numpy()[at], "v": f["v"].to_numpy()[at], "list": into[j:j + FRAME]})

    return table.mapInPandas(assign, "vec_id long, v array<double>, list long")


def grouped(rows: DataFrame) -> DataFrame:
    """``group, vec_id, v, lists``: a row for each group of lists of a vector, with its lists there (at most ``GROUP_LISTS``)."""
    group = F.floor(F.col("list") / GROUP_LISTS).alias("group")
    return rows.groupBy(group, "vec_id").agg(F.first("v").alias("v"), F.collect_set(F.col("list") % GROUP_LISTS).alias("lists"))


def blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
    """``group, n_<name>``: into how many blocks the rows of a group are dealt."""
    return rows.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(size))).cast("int").alias(f"n_{name}"))


def members(frame: pd.DataFrame) -> np.ndarray:
    """Row x list of the group: 1 where the row has the list."""
    out = np.zeros((len(frame), GROUP_LISTS), np.float32)
    n = frame["lists"].map(len).to_numpy()
    out[np.repeat(np.arange(len(frame)), n), np.concatenate(frame["lists"].to_list())] = 1
    return out


def nearest_of_block(k: int):
    def search(key, queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(found):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q, v = np.stack(queries["v"].to_list()), np.stack(found["v"].to_list())
        reads, holds = members(queries), members(found).T
        ids, own = found["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        out = []
        for at in range(0, len(q), AT_ONCE):
            rough = q[at:at + AT_ONCE] @ v.T
            rough[reads[at:at + AT_ONCE] @ holds == 0] = -np.inf
            for j, row in enumerate(rough):
                row[ids == own[at + j]] = -np.inf
                least = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
                near = np.flatnonzero((row >= least - 1e-9 * (1 + abs(least)) if np.isfinite(least) else row > -np.inf))
                # Added up anew, in one order for all rows, so that equal vectors tie.
                score = (v[near] * q[at + j]).sum(1)
                best = np.lexsort((ids[near], -score))[:k]
                out.append((np.full(len(best), own[at + j]), ids[near][best], score[best]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    return search


def nearest(table: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which ``is_query`` holds."""
    spark = table.sparkSession
    python_tasks(spark)
    rows = usable(table)
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if dims is None:
        return spark.createDataFrame([], RESULT)
    rows = materialise(rows.filter(F.size("v") == dims["dim"]), "vectors")
    norm = rows.agg(F.sqrt(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()[0]
    part = min(1.0, FIT_ROWS / dims["n"])
    sample = rows.filter(F.pmod(F.xxhash64(F.lit("fit"), "vec_id"), F.lit(1 << 30)) < int(part * (1 << 30))) if part < 1 else rows
    fitted = fit(np.stack([np.array(r["v"]) for r in sample.orderBy("vec_id").collect()] or [np.ones(dims["dim"])]), norm, dims["n"])
    lists = spark.sparkContext.broadcast(fitted)
    posted = materialise(dealt(rows, lists, "homes", query=False), "vector-lists")
    sizes = np.zeros(len(fitted.centroids), np.int64)
    for r in posted.groupBy("list").count().collect():  # at most one row per centroid
        sizes[r["list"]] = r["count"]
    asked = materialise(dealt(rows.filter(is_query), lists, "probes", True, sizes, k), "vector-queries")
    posted, asked = materialise(grouped(posted), "vector-rows"), materialise(grouped(asked), "vector-asked")
    sizes = materialise(blocks(posted, "rows", ROW_BLOCK).join(blocks(asked, "queries", QUERY_BLOCK), "group"), "vector-blocks")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))
    every = {"rows": F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1)), "queries": F.explode(F.sequence(F.lit(0), F.col("n_queries") - 1))}
    left = asked.join(sizes, "group").withColumn("q_block", block % F.col("n_queries")).withColumn("r_block", every["rows"])
    right = posted.join(sizes, "group").withColumn("r_block", block % F.col("n_rows")).withColumn("q_block", every["queries"])
    keys = ["group", "r_block", "q_block"]
    left, right = (x.select(*(F.col(c).cast("long").alias(c) for c in keys), "vec_id", "v", "lists") for x in (left, right))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        nearest_of_block(k), "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
