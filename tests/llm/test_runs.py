import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from railyard.llm import queries
from railyard.llm.runs import Level, find_runs, runs_of
from tests.conftest import SF_SMALL


def brute(words, least=12):
    """``(start, length, period)`` of every run, by looking at all periods."""
    found, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            s = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - s >= max(least, 2 * p):
                found.setdefault((s, i + p - s), p)
            i += i == s
    return sorted((s, m, p) for (s, m), p in found.items())


def made(r):
    n = r.randrange(r.choice([20, 60, 200]))
    kind = r.randrange(5)
    if kind < 2:
        return [r.randrange(2 + kind) for _ in range(n)]
    if kind == 2:
        w = []
        while len(w) < n:
            w += [r.randrange(2) for _ in range(r.randrange(1, 30))] * r.randrange(1, 4)
            w += w[-r.randrange(1, 40):] * (r.random() < 0.3)
        return w
    if kind == 3:  # Fibonacci words have the most runs
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    w = [0]
    while len(w) < n:
        w = w + [1 - x for x in w]
    return w + w


@pytest.mark.parametrize("least", [1, 2, 3, 5, 12, 20])
def test_runs_as_by_brute_force(least):
    r = random.Random(least)
    for _ in range(250):
        w = made(r)
        x = runs_of(np.array(w, np.int64), least)
        assert sorted(zip(x.start.tolist(), x.length.tolist(), x.period.tolist())) == brute(w, least)


def test_long_repetition():
    x = runs_of(np.tile(np.arange(7), 30_000))
    assert (x.start.tolist(), x.length.tolist(), x.period.tolist()) == ([0], [210_000], [7])


def test_sparse_and_dense_levels_look_up_alike():
    at, names, where = np.array([3, 50, 70]), np.array([1, 0, 1]), np.arange(71)
    sparse = Level(at, names, 100)
    dense = Level(np.arange(71), np.where(np.isin(where, at), 0, -1), 71)
    dense.dense[at] = names
    assert sparse.dense is None and dense.dense is not None
    assert (sparse.of(where) == dense.of(where)).all()


def row(doc_id, words):
    found = brute(words)
    drop = {i for s, m, p in found for i in range(s + p, s + m)}
    best = min(((-m, s, p) for s, m, p in found), default=None)
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in sorted(found, key=lambda x: (x[0], x[2])))
    left = " ".join(w for i, w in enumerate(words) if i not in drop)
    four = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (doc_id, len(found), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def rewritten(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query_as_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = [row(d, rewritten(d, [w.decode() for w in (t or "").encode().split()])) for d, t in docs if len((t or "").split()) < 800]
    ids = {x[0] for x in want}
    got = [tuple(x) for x in queries.op11_periodic_runs(spark, SF_SMALL).collect() if x[0] in ids]
    assert sorted(got) == sorted(want) and sum(x[1] for x in want) > 10


def test_odd_rows(make_docs, odd_rows):
    rows = [*odd_rows, (90, "a b " * 20, "en", "a"), (90, "a b " * 20, "en", "a"), (91, "x y\t" * 40, None, None)]
    got = find_runs(make_docs(rows)).withColumn("runs", F.transform("runs", lambda r: F.array(r["start"], r["length"], r["period"]))).collect()
    want = []
    for doc_id, text, *_ in rows:
        w = [x.decode() for x in (text or "").encode().split()]
        found = brute(w) if len(w) < 1000 else []
        drop = {i for s, m, p in found for i in range(s + p, s + m)}
        want.append((doc_id, len(w), [list(x) for x in found], " ".join(x for i, x in enumerate(w) if i not in drop)))
    key = lambda x: (str(x[0]), x[3])
    assert sorted((tuple(x) for x in got), key=key) == sorted(want, key=key)


def test_equal_documents_do_not_meet(make_docs):
    got = find_runs(make_docs([(k, "one two three four five six seven", "en", "a") for k in range(4)])).collect()
    assert [len(x["runs"]) for x in got] == [0] * 4


def test_empty_table(make_docs):
    assert find_runs(make_docs([])).collect() == []
