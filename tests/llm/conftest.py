import random

import pytest

CLASHES = ("kept", "keep_id", "component_id", "group_size", "size", "taken", "target", "key", "doc", "hash", "start", "n", "s", "ids",
           "score", "held_out", "x", "of", "bands", "text_sha256", "digest", "copies", "locator", "u", "v")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from ``(doc_id, text, lang, source)`` with further columns whose names clash with those of operators."""

    def make(rows):
        return spark.createDataFrame([(*r, len(r[1] or ""), *["clash"] * len(CLASHES)) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def words():
    r = random.Random(3)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd_rows(words):
    """Nulls, empty and very long texts, ties, repeated rows, exact and near copies."""
    r = random.Random(4)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base, long = text(150), text(6000)
    near = base.split()
    near[70] = "changed"
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, base.replace(" ", "\n\t"), "en", "b"), (4, " ".join(near), "en", "b"),
            (5, None, None, None), (6, "", "en", "a"), (7, " \n ", "en", "c"), (8, "one two", "en", "c"), (9, "One TWO", "en", None),
            (10, long, "en", "a"), (11, long + " " + base, "en", "a"), (12, base + " " + long, "en", "b"),
            (13, "x" * 30000, "en", "c"), (13, "x" * 30000, "en", "c"), (14, text(40), None, "b"), (14, text(30), "en", "b"),
            (None, base, "en", "a"), (None, "no id", "en", "c"), (15, "12 34 !!", "en", "c"), (16, "word " * 300, "en", None)]
    return rows + [(20 + k, text(r.randrange(1, 60)), "en", r.choice("abc")) for k in range(25)]
