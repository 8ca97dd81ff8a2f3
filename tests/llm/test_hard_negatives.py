import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from railyard.llm.hard_negatives import bounds, encode, exact, mine

SCHEMA = "vec_id long, label int, vector array<double>, rank string, score string, anchor string, n string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, y, v, *["clash"] * 5) for i, y, v in rows], SCHEMA)


def brute(rows, every=10):
    best = {}
    for i, y, v in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(x) for x in v]
        if i not in best or (y, v) < best[i]:
            best[i] = (y, v)
    sizes = [len(v) for _, v in best.values()]
    most = max(((sizes.count(n), n) for n in set(sizes)), default=(0, 0))[1]
    best = {i: x for i, x in best.items() if len(x[1]) == most}
    out = []
    for a in (i for i in best if i % every == 0):
        scored = sorted((-sum(p * q for p, q in zip(best[a][1], v)), i, y) for i, (y, v) in best.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == best[a][0]][:5]:
            near = [x for x in scored if x[2] != best[a][0] and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(near)]
    return sorted(out)


def mined(spark, rows):
    return sorted(map(tuple, mine(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()))


@pytest.mark.parametrize("d", [1, 5, 64, 100])
def test_bounds_hold(d):
    r = np.random.default_rng(d)
    v = np.floor(r.standard_normal((300, d)) * r.choice([0, 1, 30, 5000], (300, 1)))
    q = v[:40]
    low, high = bounds(q, encode(v))
    true = q @ v.T
    assert (low <= true).all() and (true <= high).all()
    if d == 64:  # they say something: the intervals are narrow against the vectors' lengths
        scale = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(v, axis=1)[None, :]
        assert np.median(((high - low) / np.maximum(scale, 1))[scale > 0]) < 0.6


def test_large_components_are_exact():
    a, b = np.array([[2.0 ** 40, 1.0]]), np.array([[2.0 ** 22, 3.0]])
    assert exact(a, b).tolist() == [2 ** 62 + 3]
    assert exact(a * 2, b * 2).tolist() == [2 ** 63 - 1]  # cut to a long


def test_mined_as_by_brute_force(spark):
    r = np.random.default_rng(5)
    centres = r.standard_normal((6, 16)) * 40
    rows = [(int(i), int(r.integers(4)), (centres[r.integers(6)] + r.standard_normal(16) * 25).tolist()) for i in r.permutation(400)]
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 300


def test_blocks_do_not_matter(spark, monkeypatch):
    from railyard.llm import hard_negatives
    monkeypatch.setattr(hard_negatives, "ROWS", 37)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    r = np.random.default_rng(6)
    # A hot label, many ties.
    rows = [(i, int(r.integers(3) == 0), r.integers(-2, 4, 5).astype(float).tolist()) for i in range(250)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    r = np.random.default_rng(7)
    rows = [(i, i % 3, r.integers(-9, 30, 4).astype(float).tolist()) for i in range(60)]
    rows += [(100, 1, None), (101, None, [1.0] * 4), (None, 1, [1.0] * 4), (102, 1, [1.0, None, 2.0, 3.0]), (103, 1, [math.nan] * 4),
             (104, 1, [math.inf, 0.0, 0.0, 0.0]), (105, 1, [5.0] * 7), (110, 1, []), (120, 9, [3.0, 1.0, 2.0, 2.0]), (130, 2, [0.0] * 4),
             (20, 2, [-50.0, 1.0, 1.0, 1.0]), (140, 0, [-0.5, 0.5, 7.5, 8.25]), (140, 0, [-0.5, 0.5, 7.5, 8.25])]
    assert mined(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, 1, None)]) == []
