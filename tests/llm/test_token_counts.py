import random

import public_tokenizers
import pytest

from railyard.llm.token_counts import PartCounts, by_bytes, count_tokens

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    t.no_truncation()
    t.no_padding()
    return t


def test_odd_rows_as_the_library_counts_them(make_docs, odd_rows, library):
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(make_docs(odd_rows)).collect()), key=str)
    n = [len(x.ids) for x in library.encode_batch([r[1] or "" for r in odd_rows], add_special_tokens=False)]
    assert got == sorted(((r[0], len((r[1] or "").encode()), k, k > 2048) for r, k in zip(odd_rows, n)), key=str)
    assert any(k > 2048 for k in n)


def test_split_is_safe_on_strange_text(library):
    r = random.Random(5)
    bits = ["a", "B", "Σ", "ς", "İ", "é", "́", "<|endoftext|>", "<|startoftext|>", " ", "\t", "\r\n", " ", " ", "\x1c",
            "\x85", "'s", "'LL", "9", "٣", "!", "🙂", "‍", "한", "x" * 200, "\x00", "　", "ﬁ"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(25))) for _ in range(4000)]
    counts = PartCounts(str(public_tokenizers.path("word_bpe_49k.json")))
    assert counts.count(texts) == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def test_groups_by_bytes():
    assert list(by_bytes([b"aa", b"bb", b"cccccc", b"d"], 4)) == [[b"aa", b"bb"], [b"cccccc"], [b"d"]]


def test_empty_table(make_docs):
    assert count_tokens(make_docs([])).collect() == []
