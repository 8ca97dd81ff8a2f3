import hashlib
import re
from collections import defaultdict

from railyard.llm.exact_dedup import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for doc_id, text, *_ in rows:
        groups[norm(text)].append(doc_id)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in df.collect()), key=str)


def test_odd_rows(make_docs, odd_rows):
    assert rows_of(exact_dedup(make_docs(odd_rows))) == brute(odd_rows)


def test_empty_table(make_docs):
    assert exact_dedup(make_docs([])).collect() == []


def test_state_goes_on_from_the_checkpoint(spark, make_docs, tmp_path):
    """A second run over more files of the same folder adds to the kept state."""
    from railyard.llm.exact_dedup import digests, keyed_state
    keys, check = f"{tmp_path}/keys", f"{tmp_path}/state"
    digests(make_docs([(5, "same", "en", "a"), (6, "other", "en", "a")])).write.parquet(keys)
    assert {r.keep_id for r in keyed_state(spark.read.parquet(keys), check).collect()} == {5, 6}
    digests(make_docs([(3, "same", "en", "a")])).write.mode("append").parquet(keys)
    got = {r.keep_id: r.group_size for r in keyed_state(spark.read.parquet(keys), check).collect()}
    assert got == {3: 2, 6: 1}


def test_two_texts_under_one_digest_stay_apart(spark, make_docs, monkeypatch):
    """With a digest that tells nothing, the full texts decide."""
    from pyspark.sql import functions as F
    import railyard.llm.exact_dedup as m
    monkeypatch.setattr(m.F, "sha2", lambda c, n: F.lit("same"))
    rows = [(1, "a b", "en", "s"), (2, "a  b", "en", "s"), (3, "c", "en", "s"), (4, "c", "en", "s")]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup(make_docs(rows)).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 2), 4: (3, 2)}


def test_no_python_workers_start(make_docs, monkeypatch):
    """Rows made from Python lists pass through a Python worker on each executor, which then stays; this operator needs none."""
    from pyspark.sql import SparkSession
    docs = make_docs([(1, "a b", "en", "s"), (2, "a  b", "en", "s")])

    def no_lists(*args, **kwargs):
        raise AssertionError("rows from a Python list")

    monkeypatch.setattr(SparkSession, "createDataFrame", no_lists)
    assert {r.doc_id: r.keep_id for r in exact_dedup(docs).collect()} == {1: 1, 2: 1}
