"""Hard negatives by rotated one-bit codes with deterministic bounds.

* Codes: a vector is turned by a fixed random rotation and its signs are kept,
  one bit a component, with its alignment: the length of its projection on the
  unit vector of those signs. What the projection leaves is coded again after
  another rotation, ``CODES`` times, and the length of the rest is kept.
* Bounds: an anchor's rotated components are rounded to bytes, so that its
  product with a code is a few counts of bits. The sum of these products times
  the alignments estimates the inner product; by Cauchy and Schwarz the rest
  adds at most its length times the anchor's, and the rounding at most its own
  length times the vector's. So each estimate comes with an interval that is
  never wrong.
* Filtering: of a block of rows only those remain whose interval reaches the
  wanted range and is not below that of enough rows that are surely in it.
  These are scored with their integer components, so results are exact.
* Rows and anchors are dealt into blocks (a hot label into many), and each pair
  of blocks is one group: every anchor meets every row of its label, and then
  every row of another. Blocks return their few best rows.

Defined cases: rows with a null id, label, vector, or any null or non-finite
component take no part, nor vectors of another length than most; of rows that
repeat an id the smallest (by label, then components) counts; an anchor whose
label has no other row has no positives, and so no negatives; ties go to the
smaller id; components and scores beyond a long are cut to it; an empty table gives an empty
result. Only the named columns are read.
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

#: Codes of a vector, and bits to which an anchor's components are rounded.
CODES, PLANES = 6, 8
#: Rows and anchors of a block.
ROWS, ANCHORS = 4096, 512
#: Part of the product of lengths by which bounds are widened against rounding errors.
ROUNDING = 1e-9
#: Below this, sums of products of doubles that hold integers are exact.
EXACT = 2.0 ** 53
CODED = "vec_id long, label long, anchor boolean, vector binary, code binary, kept binary"
POSITIVES = "anchor_id long, vec_id long, score long"
NEGATIVES = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def usable(table: DataFrame, is_anchor: Column) -> DataFrame:
    """``vec_id, label, anchor, v``: one usable vector of integers per id, all of the most common length."""
    whole = lambda x: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.floor(x).cast("double"))
    v = F.transform(F.col("vector").cast("array<double>"), whole)
    rows = table.select("vec_id", F.col("label").cast("long").alias("label"), v.alias("v"),
                        F.coalesce(is_anchor, F.lit(False)).alias("anchor")) \
        .filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL)")
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("vec_id", "r.label", "r.v", "r.anchor")
    sizes = one.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("times"))
    most = sizes.agg(F.max(F.struct("times", "n")).alias("m")).select("m.n")
    return one.join(F.broadcast(most), F.size("v") == F.col("n"), "left_semi")


def rotations(d: int) -> list[np.ndarray]:
    """A fixed random rotation for each code."""
    out = []
    for k in range(CODES):
        q, r = np.linalg.qr(np.random.default_rng(1000 * d + k).standard_normal((d, d)))
        out.append(q * np.sign(np.diag(r)))
    return out


class Codes(NamedTuple):
    """Per row and code the signs' bits and the alignment; the length of what is left, and of the vector."""

    bits: np.ndarray
    align: np.ndarray
    rest: np.ndarray
    length: np.ndarray


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    n, d = bits.shape
    wide = np.zeros((n, -(-d // 64) * 64), np.uint8)
    wide[:, :d] = bits
    return np.packbits(wide, 1).view(np.uint64)


def encode(v: np.ndarray) -> Codes:
    d = v.shape[1]
    left, bits, align = v.copy(), [], []
    for turn in rotations(d):
        x = left @ turn
        signs = np.where(x > 0, 1.0, -1.0)
        align.append((x * signs).sum(1) / np.sqrt(max(d, 1)))
        bits.append(packed(x > 0))
        left = left - (signs * (align[-1] / np.sqrt(max(d, 1)))[:, None]) @ turn.T
    return Codes(np.stack(bits, 1), np.stack(align, 1), np.linalg.norm(left, axis=1), np.linalg.norm(v, axis=1))


def bounds(anchors: np.ndarray, rows: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Anchor x row: numbers between which the inner product surely lies."""
    d = anchors.shape[1]
    estimate, error = np.zeros((len(anchors), len(rows.rest))), np.zeros(len(anchors))
    lengths = np.linalg.norm(anchors, axis=1)
    for k, turn in enumerate(rotations(d)):
        x = anchors @ turn
        low = x.min(1, initial=0)
        step = np.maximum((x.max(1, initial=0) - low) / ((1 << PLANES) - 1), 1e-300)
        level = np.rint((x - low[:, None]) / step[:, None]).astype(np.int64)
        off = np.linalg.norm(x - low[:, None] - step[:, None] * level, axis=1)
        ones = np.zeros(estimate.shape, np.int64)  # sum of the levels at the bits that are set
        for b in range(PLANES):
            plane = packed((level >> b) & 1 == 1)
            for w in range(plane.shape[1]):
                ones += np.bitwise_count(plane[:, w, None] & rows.bits[None, :, k, w]).astype(np.int64) << b
        n_set = np.bitwise_count(rows.bits[:, k]).sum(1).astype(np.int64)
        signed = low[:, None] * (2 * n_set - d)[None, :] + step[:, None] * (2 * ones - level.sum(1)[:, None])
        estimate += signed / np.sqrt(max(d, 1)) * rows.align[None, :, k]
        error = np.maximum(error, off)
    # A code's rounding counts times its alignment.
    width = error[:, None] * np.abs(rows.align).sum(1)[None, :] + lengths[:, None] * (rows.rest + ROUNDING * rows.length)[None, :]
    return estimate - width, estimate + width


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, row by row, of integers held as doubles."""
    d = max(a.shape[1], 1)
    if len(a) and np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * d >= EXACT:
        big = [sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True)]
        return np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in big], np.int64)
    return np.einsum("ij,ij->i", a, b).astype(np.int64)


def coded(rows: DataFrame) -> DataFrame:
    """Every vector with its codes, as bytes."""

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            v = np.stack(f["v"].to_list()).astype("<f8")
            c = encode(v)
            kept = np.concatenate([c.align, c.rest[:, None], c.length[:, None]], 1)
            yield pd.DataFrame({"vec_id": f["vec_id"], "label": f["label"], "anchor": f["anchor"], "vector": [x.tobytes() for x in v],
                                "code": [x.tobytes() for x in c.bits], "kept": [x.tobytes() for x in kept]})

    return rows.select("vec_id", "label", "anchor", "v").mapInPandas(add, CODED)


def matrix(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def codes_of(frame: pd.DataFrame) -> Codes:
    kept = matrix(frame["kept"], "<f8")
    bits = np.frombuffer(b"".join(frame["code"]), np.uint64).reshape(len(frame), CODES, -1)
    return Codes(bits, kept[:, :CODES], kept[:, CODES], kept[:, CODES + 1])


def ranked(best: np.ndarray, ids: np.ndarray, of: np.ndarray, k: int) -> np.ndarray:
    """Which of the scored pairs are among the ``k`` first of what they belong to."""
    order = np.lexsort((ids, -best, of))
    begin = np.searchsorted(of[order], of[order])
    return order[np.arange(len(order)) - begin < k]


def surest(low: np.ndarray, sure: np.ndarray, k: int) -> np.ndarray:
    """Per anchor a bound that at least ``k`` of the sure rows reach; below it no row can be among the first."""
    if low.shape[1] < k:
        return np.full(len(low), -np.inf)
    return np.partition(np.where(sure, low, -np.inf), low.shape[1] - k, axis=1)[:, low.shape[1] - k]


def positives_of_block(k: int):
    def search(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(rows):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("anchor_id", "vec_id", "score")})
        q, v = matrix(anchors["vector"], "<f8"), matrix(rows["vector"], "<f8")
        low, high = bounds(q, codes_of(rows))
        ids, anchor_ids = rows["vec_id"].to_numpy(), anchors["vec_id"].to_numpy()
        other = ids[None, :] != anchor_ids[:, None]
        a, r = np.nonzero(other & (high >= surest(low, other, k)[:, None]))
        score = exact(q[a], v[r])
        top = ranked(score, ids[r], a, k)
        return pd.DataFrame({"anchor_id": anchor_ids[a[top]], "vec_id": ids[r[top]], "score": score[top]})

    return search


def negatives_of_block(k: int, low_percent: int, high_percent: int):
    def search(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: pd.Series(dtype="int64") for c in ("anchor_id", "positive_id", "positive_score", "vec_id", "score")})]
        if not len(anchors) or not len(rows):
            return out[0]
        q, v = matrix(anchors["vector"], "<f8"), matrix(rows["vector"], "<f8")
        low, high = bounds(q, codes_of(rows))
        ids = rows["vec_id"].to_numpy()
        different = rows["label"].to_numpy()[None, :] != anchors["label"].to_numpy()[:, None]
        listed = anchors["positives"].to_list()
        for slot in range(max(map(len, listed))):
            has = np.flatnonzero([len(x) > slot for x in listed])
            p = np.array([listed[i][slot]["score"] for i in has], np.int64)
            least, most = (low_percent / 100 * p)[:, None], (high_percent / 100 * p)[:, None]
            slack = 1e-9 * np.abs(p)[:, None]
            lo, hi, may = low[has], high[has], different[has]
            sure = may & (lo >= least + slack) & (hi <= most - slack)
            may &= (hi >= least - slack) & (lo <= most + slack) & (hi >= surest(lo, sure, k)[:, None])
            a, r = np.nonzero(may)
            score = exact(q[has[a]], v[r])
            # Python's integers, as a hundred times a score may be beyond a long.
            inside = np.array([low_percent * y <= 100 * x <= high_percent * y for x, y in zip(score.tolist(), p[a].tolist(), strict=True)], bool)
            a, r, score = a[inside], r[inside], score[inside]
            top = ranked(score, ids[r], a, k)
            a = a[top]
            out.append(pd.DataFrame({"anchor_id": anchors["vec_id"].to_numpy()[has[a]],
                                     "positive_id": np.array([listed[i][slot]["vec_id"] for i in has], np.int64)[a],
                                     "positive_score": p[a], "vec_id": ids[r[top]], "score": score[top]}))
        return pd.concat(out, ignore_index=True)

    return search


def first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` best of each, with their ``rank``."""
    order = W.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def blocks(n: Column, size: int) -> Column:
    return F.greatest(F.ceil(n / size), F.lit(1)).cast("int")


def bucket(n: Column, seed: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "vec_id"), n).cast("int")


def met(anchors: DataFrame, rows: DataFrame, keys: list[str]):
    """Blocks of rows, each with each block of anchors under the same keys. Both have ``row_blocks`` and ``anchor_blocks``."""
    to_rows = anchors.withColumn("a", bucket(F.col("anchor_blocks"), "anchor")).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
    to_anchors = rows.select([F.col(c).alias(c) for c in rows.columns])  # columns of its own, as both come from one table
    to_anchors = to_anchors.withColumn("r", bucket(F.col("row_blocks"), "row")).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("anchor_blocks") - 1)))
    by = [*keys, "a", "r"]
    return to_rows.groupBy(*by).cogroup(to_anchors.groupBy(*by))


def mine(table: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low_percent: int = 80, high_percent: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``vec_id, label, vector``.

    Components count as integers (rounded down). An anchor's positives are the first other rows of its
    label; for each, the first rows of other labels whose score is from ``low_percent`` to
    ``high_percent`` of the positive's.
    """
    python_tasks(table.sparkSession)
    rows = materialise(coded(usable(table, is_anchor)), "coded")
    of_label = rows.groupBy("label").agg(blocks(F.count(F.lit(1)), ROWS).alias("row_blocks"),
                                         blocks(F.sum(F.col("anchor").cast("int")), ANCHORS).alias("anchor_blocks"))
    dealt = rows.join(of_label, "label")
    found = met(dealt.filter("anchor"), dealt, ["label"]).applyInPandas(positives_of_block(n_positives), POSITIVES)
    positives = materialise(first(found, ["anchor_id"], n_positives), "positives")

    listed = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    sums = rows.agg(blocks(F.count(F.lit(1)), ROWS).alias("row_blocks"),
                    blocks(F.sum(F.col("anchor").cast("int")), ANCHORS).alias("anchor_blocks"))
    dealt = rows.join(F.broadcast(sums))  # one row
    found = met(dealt.filter("anchor").join(listed, "vec_id"), dealt, []).applyInPandas(
        negatives_of_block(n_negatives, low_percent, high_percent), NEGATIVES)
    return first(found, ["anchor_id", "positive_id"], n_negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
