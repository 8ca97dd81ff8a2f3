import random
import re
from itertools import combinations

import numpy as np
import pytest

from railyard.llm import near_dedup
from railyard.llm.components import components
from railyard.llm.near_dedup import digest
from railyard.llm.shingles import double_sets, shingle_sets, word_hashes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, width=3):
    w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, percent=85, width=3):
    every = [(r[0], shingles(r[1], width)) for r in rows]
    # Of rows that repeat an id the smallest set that is not empty counts, by size and digest.
    order = lambda r: (len(shingles(r[1], width)), *digest(shingle_sets([r[1].encode()], width)[0]))
    chosen = {}
    for r in rows:
        if r[0] is not None and shingles(r[1], width):
            chosen[r[0]] = min(chosen.get(r[0], r), r, key=order)
    sets = [(i, shingles(r[1], width)) for i, r in chosen.items()]
    low = {i: i for i, _ in every if i is not None}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            low[b] = a
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in every), key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def altered(words, r, n_rows, n_words=120):
    """Copies of one text with ever more changed words, so that similarities spread around the limit."""
    base = [r.choice(words) for _ in range(n_words)]
    out = []
    for k in range(n_rows):
        w = list(base)
        for _ in range(r.randrange(1, 10)):
            w[r.randrange(n_words)] = r.choice(words) + str(r.randrange(50))
        out.append((1000 + k, " ".join(w), "en", "a"))
    return out


def test_shingle_hashes_agree_with_words(words):
    r = random.Random(2)
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(6))) for _ in range(300)] + ["A b", "a  B", "é É", " x ", ""]
    sets = shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    by_set, by_hash = {}, {}
    for k, (t, s) in enumerate(zip(texts, sets)):
        by_set.setdefault(shingles(t), []).append(k)
        by_hash.setdefault(s.tobytes(), []).append(k)
    assert list(by_set.values()) == list(by_hash.values())


def test_odd_rows(make_docs, odd_rows):
    assert rows_of(near_dedup.near_duplicates(make_docs(odd_rows))) == brute(odd_rows)


def thue_morse(n):
    """The two words of ``2 ** n`` letters that every polynomial hash modulo a power of two takes for one."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("n", [10, 12])
def test_words_that_polynomials_confuse(make_docs, n):
    a, b = thue_morse(n)
    rows = [(1, f"one two {a}", "en", "s"), (2, f"one two {b}", "en", "s"), (3, f"{a} {b} {a} {b} x", "en", "s"), (4, f"{b} {a} {b} {a} x", "en", "s")]
    assert rows_of(near_dedup.near_duplicates(make_docs(rows))) == brute(rows)
    assert len({tuple(word_hashes([t.encode()], seed)[0]) for t in (a, b) for seed in (0, 1)}) == 4


def test_repeated_id_with_different_texts(make_docs, words):
    r = random.Random(12)
    one, two = (" ".join(r.choice(words) for _ in range(n)) for n in (60, 90))
    rows = [(7, two, "en", "s"), (7, one, "en", "s"), (7, "", "en", "s"), (8, one, "en", "s"), (9, two, "en", "s"), (10, one + " more", "en", "s")]
    assert rows_of(near_dedup.near_duplicates(make_docs(rows))) == brute(rows)


def test_second_hashes_are_independent(words):
    text = " ".join(words[:50])
    first, second = double_sets([text.encode()])[0]
    assert len(first) == len(second) == 48 and not set(first.tolist()) & set(second.tolist())
    assert (first == shingle_sets([text.encode()])[0]).all()


@pytest.mark.parametrize("few", [32, 2])
def test_altered_copies_around_the_limit(make_docs, words, monkeypatch, few):
    """Both ways of comparing what a star leaves open lose no link."""
    monkeypatch.setattr(near_dedup, "FEW", few)
    r = random.Random(8)
    rows = altered(words, r, 70) + [(k, " ".join(r.choice(words) for _ in range(30)), "en", "b") for k in range(40)]
    assert rows_of(near_dedup.near_duplicates(make_docs(rows))) == brute(rows)


def test_five_words_and_another_limit(make_docs, words):
    rows = altered(words, random.Random(9), 25, 200)
    assert rows_of(near_dedup.near_duplicates(make_docs(rows), near_dedup.Rule(width=5, percent=80))) == brute(rows, 80, 5)


def test_empty_table_and_repeated_ids(make_docs):
    assert near_dedup.near_duplicates(make_docs([])).collect() == []
    got = near_dedup.near_duplicates(make_docs([(1, "a b c d", "en", "s"), (1, "a b c d", "en", "s"), (1, "p q r", "en", "s")])).collect()
    assert len(got) == 3 and {r.component_id for r in got} == {1}


def test_components_of_a_long_chain_and_a_hub(spark):
    r = random.Random(1)
    pairs = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 200)] + [(5, 5)]
    pairs = [p if r.random() < 0.5 else p[::-1] for p in pairs]
    got = {x.node: x.component for x in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100 + k: 100 for k in range(200)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_minima_estimate_similarity():
    from railyard.llm.shingles import Hashes, mixed
    x = mixed(np.arange(2000, dtype=np.uint64))
    family = Hashes.family(512)
    same = (family.minima(x[:1500]) == family.minima(x[500:])).mean()
    assert abs(same - 0.5) < 0.1


def test_differences_of_one_component_are_not_paired(spark, monkeypatch):
    """Copies of a group that are linked already cost no rows, whatever they share; nodes still apart are found."""
    put = {}
    write = near_dedup.materialise
    monkeypatch.setattr(near_dedup, "materialise", lambda df, name: put.setdefault(name, write(df, name)))
    numbers = {1: range(100), 50: [*range(50), *range(2000, 2050)], 51: [*range(50), *range(2000, 2049), 2060]}
    numbers |= {k: [*range(100), 1000] for k in range(2, 42)}
    sets = [(k, bytearray(np.array(v, np.uint64).tobytes())) for k, v in numbers.items()]
    rest = [(1, 1, k, k if k >= 50 else 1, len(v)) for k, v in numbers.items()]
    found = near_dedup.across_many(spark.createDataFrame(rest, "leader long, leader_component long, doc_id long, component long, n long"),
                                   spark.createDataFrame([(*s, s[1]) for s in sets], "doc_id long, s binary, s2 binary"), 85).collect()
    assert [(r.a, r.b) for r in found] == [(50, 51)]
    assert 0 < put["near-prefixes"].count() and put["near-prefixes"].filter("e = 1000 OR doc_id < 50").isEmpty()
