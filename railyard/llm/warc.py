"""Content-addressed web archive (WARC/1.1).

An archive is two tables. ``payloads`` holds the bytes of each distinct
payload once, under their SHA-256 digest. ``heads`` holds, per record, the
exact bytes in front of the payload (WARC header block, and for a response the
HTTP head) and the digest. A record is rebuilt byte for byte by joining the
two. Digests are verified twice: when the archive is written all payloads under
a digest must agree in a second hash, and when it is read every payload is
hashed again; a difference ends the job with an error.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with
the largest ``page_id`` is the response and the others revisit it; smaller
payloads are always responses.

Defined cases: a null html is an empty payload; a null url gives an empty
target; a null ``page_id`` is smaller than any other, and where a group has no
other its rows are all responses; rows repeating the ``page_id`` of the
response are responses too; an empty table gives an empty archive. Line breaks
in urls are percent-encoded, as they would end the header. Only ``page_id``,
``url`` and ``html`` are read, so other columns of any name cannot clash.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.session import scratch_path

MIN_REVISIT = 1000
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What ends a record in a WARC file.
RECORD_END = CRLF * 2
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "


class Archive(NamedTuple):
    """The folder of the heads, and the name of the payloads' table (its files lie in the session's warehouse)."""

    heads: str
    payloads: str


def record_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, payload, n, digest, keeper``: ``keeper`` is the id of the response to revisit, else null."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("n"), F.sha2(payload, 256).alias("digest"),
                        F.sha1(payload).alias("sha1"))
    groups = rows.filter(F.col("n") >= min_revisit).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("k")) \
        .filter("k > 1").drop("k")
    return rows.join(groups, "digest", "left")


def heads(rows: DataFrame, date: str) -> DataFrame:
    """``page_id, digest, head``: the exact bytes of a record in front of its payload."""
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    http = F.concat(F.lit(HTTP_HEAD), F.col("n").cast("string"), F.lit(CRLF * 2))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(CRLF))

    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_urn(F.col("page_id"))), line("WARC-Date", date), line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", record_urn(F.col("keeper"))), line("WARC-Profile", PROFILE)))
        .otherwise(F.lit("")),
        line("Content-Type", "application/http;msgtype=response"), line("Content-Length", length.cast("string")),
        F.lit(CRLF), http)
    return rows.select("page_id", "digest", head.cast("binary").alias("head"))


def write_archive(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", archive: Archive | None = None) -> Archive:
    """Write the two tables; by default into the shared checkpoint folder and a new table of the warehouse.

    The payloads are bucketed by digest, so that reading records moves the narrow heads and not the payloads.
    """
    spark = pages.sparkSession
    archive = archive or Archive(scratch_path(spark, "llm-warc-heads"), f"warc_payloads_{uuid.uuid4().hex}")
    rows = plan_records(pages)
    other = F.xxhash64("payload")
    same = F.assert_true(F.col("low") == F.col("high"), "two payloads share a digest")
    (rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min(other).alias("low"), F.max(other).alias("high"))
     .filter(same.isNull()).drop("low", "high")
     .write.mode("overwrite").option("compression", "zstd")
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "digest").saveAsTable(archive.payloads))
    heads(rows, date).write.mode("overwrite").parquet(archive.heads)
    return archive


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """``page_id, head, payload, record``: the original records, rebuilt by a join.

    ``payload`` is the full payload also for a revisit (that is what the join
    is for); ``record`` is what a WARC file holds for it, a revisit without the payload.
    """
    stored = spark.table(archive.payloads)
    true = F.assert_true(F.sha2("payload", 256) == F.col("digest"), "a stored payload differs from its digest")
    rows = spark.read.parquet(archive.heads).join(stored.filter(true.isNull()), "digest")
    is_revisit = field("WARC-Type") == "revisit"
    end = F.lit(RECORD_END).cast("binary")
    record = F.when(is_revisit, F.concat("head", end)).otherwise(F.concat("head", "payload", end))
    return rows.select("page_id", "head", "payload", record.alias("record"))


def field(name: str) -> Column:
    """The value of a WARC header line; empty if there is none. Urls cannot hold line breaks, so the first is it."""
    return F.regexp_extract(F.col("head").cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def describe(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` as read from the rebuilt records."""
    fields = records.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
                            F.sha1("payload").alias("payload_digest"), field("WARC-Type").alias("record_type"),
                            F.regexp_extract(field("WARC-Refers-To"), r"^<urn:page:(-?\d+)>$", 1).alias("refers"),
                            field("WARC-Payload-Digest").alias("said"))
    true = F.assert_true(F.col("said") == F.concat(F.lit("sha1:"), F.col("payload_digest")), "a header names another payload")
    return fields.filter(true.isNull()).select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("refers") != "", F.col("refers").cast("long")).alias("refers_to"))


def export_warc(spark: SparkSession, archive: Archive, path: str) -> None:
    """Write plain WARC files (gzip), one per task; payloads are UTF-8 text, and the records end with two line breaks."""
    body = F.expr(f"substr(record, 1, octet_length(record) - {len(RECORD_END)})").cast("string")
    read_records(spark, archive).select(body.alias("value")).write.mode("overwrite") \
        .option("lineSep", RECORD_END).option("compression", "gzip").text(path)
