"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of words that repeats with its smallest period, is at least
two periods and ``least`` words long, and cannot be extended on either side.

* Names: for each power of two, factors of that many words get the same name if
  they are equal and in the same document. The name of a factor of twice the
  length is that of the pair of its halves. Factors that occur once keep no
  name, so from a few words on hardly any position of common prose is left.
* Proposals: a run whose period is from m up to 2m has, at its start, a factor
  of m words that occurs again one period later. Occurrences of a factor that
  are at most half its length apart form an arithmetic progression whose
  difference is the factor's own period, so within twice the length there are
  only a few progressions. Proposed are the difference of each progression, the
  distances from each occurrence to the first ones of the progressions after
  it, and the distances between the last ones. One of them is the period: either
  the factor's own period breaks off inside the first period of the run, and so
  in the second, at the same distance; or it holds all through the first, and
  then the second period begins a progression.
* Extension: names also give how far two positions agree, forwards and
  backwards, by halving steps. That turns a proposal into its longest stretch;
  of equal stretches the smallest period is the right one.

Many short documents are handled as one array, a long one alone. Work grows
with the words times the logarithm of the longest repeated stretch.

Defined cases: a null text counts as empty, and an empty one has no words and no
runs; repeated rows are handled each; a text without repetition comes back with
single spaces. Only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.tables import documents, python_tasks

LEAST = 12
#: Bytes of text whose words are handled as one array (a longer document alone).
GROUP_BYTES = 2 << 20
#: Levels on which fewer than one position in so many has a name are kept as lists of positions.
SPARSE = 16
RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Level:
    """Names of the factors of one length, by position; -1 where a factor occurs once."""

    def __init__(self, at: np.ndarray, names: np.ndarray, n: int):
        self.positions, self.names, self.dense = at, names, None
        if len(at) * SPARSE > n:
            self.dense = np.full(n + 1, -1, np.int64)
            self.dense[at] = names

    def of(self, at: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense[at]
        if not len(self.positions):
            return np.full(len(at), -1, np.int64)
        k = np.minimum(np.searchsorted(self.positions, at), len(self.positions) - 1)
        return np.where(self.positions[k] == at, self.names[k], -1)


class Runs(NamedTuple):
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def named(keys: np.ndarray, at: np.ndarray, n: int) -> Level:
    """A level from the keys of some positions, of which only those that occur again get a name."""
    _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = times > 1
    names = (np.cumsum(again) - 1)[inverse]
    on = again[inverse]
    return Level(at[on], names[on], n)


def basic_factors(words: np.ndarray) -> list[Level]:
    """Levels of 1, 2, 4 ... words, up to the last on which anything occurs again."""
    n, levels = len(words), [named(words, np.arange(len(words)), len(words))]
    while len(levels[-1].positions):
        last, half = levels[-1], 1 << (len(levels) - 1)
        at = last.positions[last.positions + half < n]
        second = last.of(at + half)
        on = second >= 0
        first = last.of(at[on])
        levels.append(named(first * (second.max(initial=0) + 1) + second[on], at[on], n))
    return levels[:-1]


def proposals(level: Level, m: int, least_period: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and the periods proposed for them by the factors of ``m`` words."""
    order = np.argsort(level.names, kind="stable")
    at, name = level.positions[order], level.names[order]
    gap, same = np.diff(at), np.diff(name) == 0
    near = same & (2 * gap <= m)
    begins = np.concatenate([[True], ~near])
    of = np.cumsum(begins) - 1  # the progression of each occurrence
    first = np.flatnonzero(begins)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    inner = first[last > first]
    found = [(at[inner], at[inner + 1] - at[inner])]
    for ahead in range(1, 5):
        other = of + ahead
        t = np.flatnonzero(other < len(first))
        t = t[name[first[other[t]]] == name[t]]
        found.append((at[t], at[first[other[t]]] - at[t]))
        c = np.arange(len(first) - ahead)
        c = c[name[first[c]] == name[first[c + ahead]]]
        found.append((at[last[c]], at[last[c + ahead]] - at[last[c]]))
    i, p = (np.concatenate([f[k] for f in found]) for k in range(2))
    on = (p >= least_period) & (p <= 2 * m)
    return i[on], p[on]


def agree_forward(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For how many words the positions agree, from themselves on."""
    at = i.copy()
    shift = j - i
    for k in reversed(range(len(levels))):
        name = levels[k].of(at)
        at = at + ((name >= 0) & (name == levels[k].of(at + shift))) * (1 << k)
    return at - i


def agree_backward(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For how many words the positions agree before themselves."""
    at = i.copy()
    shift = j - i
    for k in reversed(range(len(levels))):
        before = at - (1 << k)
        name = levels[k].of(np.maximum(before, 0))
        on = (before >= 0) & (name >= 0) & (name == levels[k].of(np.maximum(before, 0) + shift))
        at = np.where(on, before, at)
    return i - at


def runs_of(words: np.ndarray, least: int = LEAST) -> Runs:
    """All runs in an array of words, of which those of different documents must differ; by start, then period."""
    levels = basic_factors(words)
    # Periods below the lowest level's length have that factor twice in a run of ``least`` words.
    lowest = max(0, (least + 1).bit_length() - 2)
    found = []
    for k in range(lowest, len(levels)):
        i, p = proposals(levels[k], 1 << k, 1 if k == lowest else 1 << k)
        key = np.unique(i * (len(words) + 1) + p)
        i, p = key // (len(words) + 1), key % (len(words) + 1)
        start = i - agree_backward(levels, i, i + p)
        length = i + p + agree_forward(levels, i, i + p) - start
        on = length >= np.maximum(least, 2 * p)
        found.append((start[on], length[on], p[on]))
    start, length, period = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    order = np.lexsort((period[new], start[new]))
    return Runs(start[new][order], length[new][order], period[new][order])


def groups(texts: list[str | None]) -> Iterator[list[bytes]]:
    group, held = [], 0
    for text in texts:
        group.append((text or "").encode())
        held += len(group[-1])
        if held >= GROUP_BYTES:
            yield group
            group, held = [], 0
    if group:
        yield group


def analysed(texts: list[bytes], least: int) -> tuple[np.ndarray, Runs, np.ndarray, list[str]]:
    """Words of each text, its runs (starts within the text, and the text of each) and what is left of it."""
    number, split = count(), [t.split() for t in texts]
    words = [np.fromiter(map(defaultdict(number.__next__).__getitem__, w), np.int64, len(w)) for w in split]
    sizes = np.array([len(w) for w in split], np.int64)
    ends = np.cumsum(sizes)
    runs = runs_of(np.concatenate(words), least)
    of = np.searchsorted(ends, runs.start, side="right")
    begins = ends - sizes
    change = np.zeros(int(ends[-1]) + 1, np.int64)
    np.add.at(change, runs.start + runs.period, 1)
    np.add.at(change, runs.start + runs.length, -1)
    kept = np.cumsum(change) == 0
    has = np.zeros(len(texts), bool)
    has[of] = True
    left = [b" ".join(w if not has[k] else [x for x, on in zip(w, kept[begins[k]:ends[k]].tolist(), strict=True) if on]).decode()
            for k, w in enumerate(split)]
    return sizes, runs._replace(start=runs.start - begins[of]), of, left


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every document of ``doc_id, text``.

    ``runs`` has ``start, length, period`` in words, by start, then period. In
    ``collapsed`` each run is cut to its first period: a word stays unless some
    run contains it after that run's first period.
    """
    python_tasks(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for group in groups(batch.column("text").to_pylist()):
                sizes, runs, of, left = analysed(group, least)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(group)))]).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in runs], names=list(runs._fields))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(done, len(group)), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), structs),
                     pa.array(left, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
                done += len(group)

    return documents(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, RESULT)
