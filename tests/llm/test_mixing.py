from collections import defaultdict

import pytest

from railyard.llm.mixing import mix, source_targets


def test_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 50), (None, 10), ("d", 0)], "source string, size long")
    got = {r.source: (r.source_size, round(r.target, 6)) for r in source_targets(sizes, (5, 2, 1), 1.5, 2.0).collect()}
    total = 1.5 * 1160
    # a, c, d and the null source stop at twice their size; b gets the rest.
    assert got == {"a": (100, 200.0), "c": (50, 100.0), "d": (0, 0.0), None: (10, 20.0), "b": (1000, total - 320)}


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    rows = mix(docs).collect()
    again = mix(docs.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(odd_rows)
    source = defaultdict(lambda: [0, None, 0])
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.taken in (0, r.size, 2 * r.size)
        key = (r.source_size, r.target)
        source[key][0] += r.taken
        source[key][2] = max(source[key][2], r.size)
    for (size, target), (taken, _, largest) in source.items():
        assert target <= 2 * size + 1e-6 and abs(taken - target) <= largest


def test_taken_words_come_near_the_target(spark, make_docs, words):
    rows = [(k, " ".join(words[: 1 + k % 37]), "en", "abcdef"[k % 6]) for k in range(3000)]
    taken = defaultdict(int)
    for r in mix(make_docs(rows)).collect():
        taken[r.source_size, r.target] += r.taken
    for (_, target), n in taken.items():
        assert n == pytest.approx(target, rel=0.01)


def test_empty_table_and_empty_texts(make_docs):
    assert mix(make_docs([])).collect() == []
    assert [(r.taken, r.target) for r in mix(make_docs([(1, "", "en", "a"), (2, None, "en", "b")])).collect()] == [(0, 0.0)] * 2


def test_own_weights_and_carried_columns(make_docs):
    rows = [(k, "w " * 10, "en", "ab"[k % 2]) for k in range(200)]
    out = mix(make_docs(rows), weights=(1,), share=0.5, carry=["size", "text"]).collect()
    assert {r.carry_size for r in out} == {"clash"} and sum(r.taken for r in out) == pytest.approx(1000, abs=20)
