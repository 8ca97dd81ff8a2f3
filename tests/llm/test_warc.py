import gzip
import hashlib
from collections import defaultdict

import pytest

from railyard.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string, n string, head string, keeper string"
BIG, UTF = "b" * 1500, "ü" * 700
ROWS = [(1, "http://a", BIG), (2, "http://b", BIG), (3, None, BIG), (4, "http://c", "small"), (5, "http://d\r\nX: y", "small"), (6, "u", None),
        (7, "u", ""), (8, "u", UTF), (9, "u", UTF), (10, "u", "c" * 100_000), (None, "u", "d" * 1000), (None, "u", "e" * 999),
        (11, "u", "line\r\n\r\nWARC/1.1\r\nWARC-Type: fake\r\n" + "z" * 1000), (3, None, BIG)]


@pytest.fixture(scope="module")
def archive(spark):
    return warc.write_archive(spark.createDataFrame([(*r, *["clash"] * 5) for r in ROWS], SCHEMA))


def test_description(spark, archive):
    groups = defaultdict(list)
    for page, _, html in ROWS:
        groups[(html or "").encode()].append(page)
    expect = []
    for payload, pages in groups.items():
        keeper = max((p for p in pages if p is not None), default=None)
        for p in pages:
            revisit = len(payload) >= 1000 and len(pages) > 1 and p != keeper and keeper is not None
            expect.append((p, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    got = [tuple(r) for r in warc.describe(warc.read_records(spark, archive)).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)


def test_payloads_are_stored_once(spark, archive):
    assert spark.table(archive.payloads).count() == len({r[2] or "" for r in ROWS})


def test_records_have_their_exact_length(spark, archive):
    for r in warc.read_records(spark, archive).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert len(rest) - 4 == int(fields[b"Content-Length"])
        body = rest[:-4].partition(b"\r\n\r\n")[2]
        assert body == (b"" if fields[b"WARC-Type"] == b"revisit" else bytes(r.payload))


def test_export_holds_all_records(spark, archive, tmp_path):
    warc.export_warc(spark, archive, f"{tmp_path}/w")
    data = b"".join(gzip.open(p).read() for p in sorted(tmp_path.glob("w/part-*")))
    records = [bytes(r.record) for r in warc.read_records(spark, archive).collect()]
    assert len(data) == sum(map(len, records)) and all(r in data for r in records)


def test_a_changed_payload_is_found(spark):
    a = warc.write_archive(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"))
    other = f"{a.payloads}_changed"
    spark.table(a.payloads).selectExpr("digest", "cast('y' as binary) AS payload").write.saveAsTable(other)
    with pytest.raises(Exception, match="differs from its digest"):
        warc.describe(warc.read_records(spark, warc.Archive(a.heads, other))).collect()
    for t in (a.payloads, other):
        spark.sql(f"DROP TABLE {t}")


def test_empty_table(spark):
    a = warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.describe(warc.read_records(spark, a)).collect() == []
