import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from railyard.llm.packing import VOCABULARY, Encoder, configurations, cut, grouped, pack, place, plan, sequences

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(str(public_tokenizers.path(VOCABULARY)))


@pytest.fixture(scope="module")
def encoder():
    return Encoder(str(public_tokenizers.path(VOCABULARY)))


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_all_code_points_as_the_library_encodes_them(library, encoder):
    for first in range(0, 0x110000, 40_000):
        texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}! {chr(c)}{chr(c)} c" for c in range(first, min(first + 40_000, 0x110000)) if not 0xD800 <= c < 0xE000]
        assert [x.ids for x in library.encode_batch(texts, add_special_tokens=False)] == [ids(encoder.encode(t)) for t in texts]


def test_every_token_is_encoded_as_itself(library, encoder):
    for text, i in library.get_vocab(with_added_tokens=False).items():
        raw = library.decoder.decode([text])
        if "�" not in raw:
            assert ids(encoder.encode(raw)) == [i]


def test_strange_texts_as_the_library_encodes_them(library, encoder):
    r = random.Random(8)
    bits = ["a", "B", "Σ", "é", "́", "<|endoftext|>", "<|endof", "text|>", " ", "  ", "\t", "\r\n", "\n\n", " ", " ", "\x1c",
            "\x85", "'s", "'LL", "9", "٣", "!", "🙂", "‍", "한", "x" * 200, "\x00", "　", "ﬁ", "the", " of"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(4000)]
    texts += [" " * 50_000 + "a", "ab" * 50_000, "\n" * 20_000, "日本語" * 9000]
    assert [x.ids for x in library.encode_batch(texts, add_special_tokens=False)] == [ids(encoder.encode(t)) for t in texts]


def test_cut():
    raw = np.arange(10, dtype="<u4").tobytes()
    assert [(s, ids(p)) for s, p in cut(raw, 4)] == [(0, [0, 1]), (2, [2, 3, 4, 5]), (6, [6, 7, 8, 9])]
    assert [(s, len(p) // 4) for s, p in cut(raw, 5)] == [(0, 5), (5, 5)]
    assert [(s, len(p) // 4) for s, p in cut(raw, 99)] == [(0, 10)]


def filled(counts, capacity):
    """Number of windows used, after a look at every piece."""
    f = plan(counts, capacity)
    given, windows = Counter(), defaultdict(list)
    for p in f.places:
        assert p.first == given[p.length]
        given[p.length] += p.n
        for j in range(p.n):
            windows[p.window + j // p.each].append((p.offset + j % p.each * p.length, p.length))
    assert given == Counter(counts)
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(windows)


def best_fit_decreasing(counts, capacity):
    rooms = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        fits = [r for r in rooms if r >= length]
        rooms.append(min(fits) - length if fits else capacity - length)
        if fits:
            rooms.remove(min(fits))
    return len(rooms)


@pytest.mark.parametrize("low, high, n, capacity", [(1, 2048, 3000, 2048), (300, 1100, 3000, 2048), (600, 1000, 3000, 2048), (1, 7, 50, 7),
                                                    (1, 1, 5, 1), (700, 700, 2000, 2048), (1, 30, 2000, 2048), (2, 100, 900, 100)])
def test_windows_are_few(low, high, n, capacity):
    counts = Counter(np.random.default_rng(n + low).integers(low, high + 1, n).tolist())
    used, least = filled(dict(counts), capacity), -(-sum(k * c for k, c in counts.items()) // capacity)
    plain = best_fit_decreasing(counts, capacity)
    assert least <= used <= 1.005 * plain + 1
    if (low, high) in ((300, 1100), (600, 1000)):  # where best fit alone does badly
        assert used < plain


def test_groups_and_configurations():
    groups = grouped({10: 5, 7: 2, 3: 6}, 3)
    assert [(g.longest, g.shortest, g.n) for g in groups] == [(10, 10, 5), (7, 3, 5), (3, 3, 3)]
    found = configurations(np.array([50, 30, 20]), np.array([40.0, 40, 40]), 100)
    assert sum(n for _, n in found) == 40 and sum(c * n for c, n in found).tolist() == [40, 40, 40]


def test_few_pieces_are_packed_optimally():
    """All packings of a few pieces: never more than one window above the best."""
    r = random.Random(2)

    def least(lengths, rooms=()):
        if not lengths:
            return len(rooms)
        best = len(rooms) + len(lengths)
        for k in {x: k for k, x in enumerate(rooms) if x >= lengths[0]}.values():
            best = min(best, least(lengths[1:], (*rooms[:k], rooms[k] - lengths[0], *rooms[k + 1:])))
        return min(best, least(lengths[1:], (*rooms, 20 - lengths[0])))

    for _ in range(30):
        lengths = sorted((r.randrange(1, 21) for _ in range(8)), reverse=True)
        assert least(lengths) <= filled(dict(Counter(lengths)), 20) <= least(lengths) + 1


def test_documents_are_packed(make_docs, odd_rows, library):
    packed = pack(make_docs(odd_rows), capacity=64, with_ids=True)
    rows = packed.collect()
    want = Counter()
    for doc_id, text, *_ in odd_rows:
        got = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(got) % 64 or min(64, len(got))
        cuts = [0, *range(first, len(got) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(doc_id, k, a, b - a, zlib.crc32(np.array(got[a:b], "<u4").tobytes()))] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in rows) == want
    windows = {x.sequence_id: x.ids for x in sequences(packed).collect()}
    assert all(windows[x.sequence_id][x.offset:x.offset + x.length] == x.ids for x in rows)
    assert sum(map(len, windows.values())) == sum(x.length for x in rows) and max(map(len, windows.values())) <= 64
    again = pack(make_docs(odd_rows[::-1]), capacity=64).collect()
    assert {(x.doc_id, x.piece, x.ids_crc32, x.sequence_id, x.offset) for x in again} == \
        {(x.doc_id, x.piece, x.ids_crc32, x.sequence_id, x.offset) for x in rows}


def test_a_hot_length_is_numbered_in_buckets(spark, monkeypatch):
    from railyard.llm import packing
    monkeypatch.setattr(packing, "BUCKET", 50)
    pieces = spark.createDataFrame([(k, 0, 0, 300 if k % 3 else 5, k) for k in range(3000)],
                                   "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = place(pieces).collect()
    assert len(rows) == 3000
    windows = defaultdict(list)
    for x in rows:
        windows[x.sequence_id].append((x.offset, x.length))
    for parts in windows.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts[:-1])]).tolist() and sum(n for _, n in parts) <= 2048
    assert len(windows) == -(-2000 // 6)  # the short ones go beside the long


def test_empty_table(make_docs):
    assert pack(make_docs([])).collect() == []
