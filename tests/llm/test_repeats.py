import hashlib
import random

import numpy as np
import pytest

from railyard.llm import repeats
from railyard.llm.columnwise import sorted_suffixes


def test_suffixes_of_small_collections():
    r = random.Random(1)
    for t in range(150):
        strings = ["".join(r.choice("ab" if t % 2 else "abcé") for _ in range(r.randrange(12))).encode() for _ in range(r.randrange(10))]
        expect = sorted((s[p:], i, p) for i, s in enumerate(strings) for p in range(len(s)))
        string, start, common = sorted_suffixes(strings)
        assert list(zip(string.tolist(), start.tolist())) == [(i, p) for _, i, p in expect]
        for (a, *_), (b, *_), n in zip(expect, expect[1:], common[1:].tolist()):
            assert a[:n] == b[:n] and a[n:n + 1] != b[n:n + 1] or a[:n] == b and len(b) == n or a == b[:n] and len(a) == n


def brute(rows, length=100):
    """Rows in the order of the documents; equal (id, text) rows are one document."""
    order = sorted({(r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest(), (r[1] or "").encode()) for r in rows})
    seen, results = set(), {}
    for none, i, _, data in order:
        cut = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - length + 1):
            s = data[k:k + length]
            if s in seen:
                cut[k:k + length] = True
            seen.add(s)
        kept = data if not cut.any() else bytes(np.frombuffer(data, np.uint8)[~cut[:-1]])
        results[None if none else i, data] = (len(data), int(cut.sum()), int((np.diff(cut.astype(int)) == -1).sum()),
                                              hashlib.sha256(kept).hexdigest())
    return sorted(((r[0], *results[r[0], (r[1] or "").encode()]) for r in rows), key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_odd_rows(make_docs, odd_rows):
    out = repeats.remove_repeats(make_docs(odd_rows))
    assert rows_of(out) == brute(odd_rows)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in out.collect())


@pytest.mark.parametrize("block", [8192, 5])
def test_shared_passages(make_docs, words, monkeypatch, block):
    """Also with blocks so small that frequent minimisers lie in several."""
    monkeypatch.setattr(repeats, "BLOCK", block)
    r = random.Random(6)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passages = [text(25) for _ in range(3)]
    rows = []
    for k in range(60):
        parts = [text(r.randrange(1, 30)), r.choice(passages), text(r.randrange(1, 8)), r.choice(passages)[r.randrange(40):]]
        r.shuffle(parts)
        rows.append((k, "é".join(parts), "en", "a"))
    rows.append((99, "ab" * 400 + text(5) + "ab" * 90, "en", "a"))
    rows.append((98, "abcdefg " * 30, "en", "a"))
    assert rows_of(repeats.remove_repeats(make_docs(rows))) == brute(rows)


def test_pieces_of_long_texts(make_docs, words, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    r = random.Random(7)
    long = " ".join(r.choice(words) for _ in range(800))
    rows = [(1, long, "en", "a"), (2, "other " + long[333:2900] + " end", "en", "a"), (3, long[:650], "en", "a")]
    assert rows_of(repeats.remove_repeats(make_docs(rows))) == brute(rows)


def test_large_and_missing_ids_repeat(make_docs, words):
    r = random.Random(9)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = text(40)
    rows = [(i, text(5) + shared + text(k), "en", "a") for i in (1 << 62, -(1 << 62), (1 << 63) - 1, None) for k in (3, 4)]
    rows += [rows[0], rows[-1], (5, shared, "en", "a")]
    assert rows_of(repeats.remove_repeats(make_docs(rows))) == brute(rows)


def test_empty_table_and_short_texts(make_docs):
    assert repeats.remove_repeats(make_docs([])).collect() == []
    rows = [(1, "a" * 99, "en", "a"), (2, "a" * 99, "en", "a"), (3, "b" * 100, "en", "a"), (4, "b" * 100, "en", "a"), (5, "c" * 101, "en", "a")]
    assert rows_of(repeats.remove_repeats(make_docs(rows))) == brute(rows)


def test_strings_are_cut_to_what_others_share(words):
    """What stands around a minimiser in one string only does not go into the transform; shared windows all do."""
    r = random.Random(5)
    text = lambda n: " ".join(r.choice(words) for _ in range(n)).encode()
    length, gram = 40, 12
    shared, strings = [text(25) for _ in range(6)], []
    for k in range(300):
        passage = shared[k % 6]
        low = r.randrange(len(passage) - 20)
        data = text(6) + passage[low:low + r.randrange(12, 70)] + text(6)
        found = repeats.strings_of([(k, 0, data)], length, gram)
        strings += [(h, own, data[s:s + n + length - 1]) for h, s, n, own in zip(*(found[c].tolist() for c in ("hash", "start", "n", "own")))]
    strings.append((0, True, b"abcde" * 13))
    only = [s for *_, s in strings]
    begin, end = repeats.shared_parts(only, np.zeros(len(only), bool), length, gram)
    holders = {}
    for k, s in enumerate(only):
        for at in range(len(s) - length + 1):
            holders.setdefault(s[at:at + length], []).append((k, at))
    several = [x for x in holders.values() if len({k for k, _ in x}) > 1]
    assert several and all(begin[k] <= at and at + length <= end[k] for x in several for k, at in x)
    with_some = {k for x in several for k, _ in x} | {k for k, (_, own, _) in enumerate(strings) if own}
    assert len(with_some) <= np.count_nonzero(end - begin >= length) < 0.7 * len(only)
    assert (begin[-1], end[-1]) == (0, 65)
    whole = repeats.shared_parts(only, np.ones(len(only), bool), length, gram)
    assert not whole[0].any() and whole[1].tolist() == [len(s) for s in only]
