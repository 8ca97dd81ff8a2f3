"""Exact de-duplication as a stateful stream.

Every row is reduced to a SHA-256 digest of its normalised text, its stable
identifier and a locator of its content, and these keys run through a
Structured Streaming aggregation whose keyed state lives on disk (RocksDB) and
never expires: per digest it keeps the smallest identifier, the locator of
that row and the number of rows. Rows whose digest occurs more than once are
then compared byte for byte with the text that stays; should two different
texts share a digest, they are grouped by the text itself.

Defined cases: a null text counts as empty, and all such rows form one group;
repeated rows count each, and rows that repeat both the text and the ``doc_id``
of the row that stays are that document again, so they are marked kept too; a
null ``doc_id`` is larger than any other, so it stays only where the whole
group has no identifier; an empty table gives an empty result. Only ``doc_id``
and ``text`` are read, so other columns of any name cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm.tables import SPACE, materialise
from railyard.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Session settings of the stream: state on disk, and a bound on what all its stores keep in memory per executor.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "false",
    # Many small stores: without this each sets aside 4 MB of disk for its logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, text_sha256, n_bytes, locator``: one narrow row per document."""
    norm = normalised(F.col("text"))
    return docs.select("doc_id", "text").select(
        "doc_id", F.sha2(norm.cast("binary"), 256).alias("text_sha256"), F.octet_length(norm).cast("long").alias("n_bytes"),
        F.input_file_name().alias("locator"))


def keyed_state(keys: DataFrame, checkpoint: str) -> DataFrame:
    """Run the keys through the stateful stream; the newest state per digest.

    ``keys`` is a table under a path that Spark can list. The stream's offsets
    and state live under ``checkpoint``; a second call with the same
    checkpoint folder and more files goes on from the kept state.
    """
    spark = keys.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")
        state = (spark.readStream.schema(keys.schema).parquet(*keys_path(keys))
                 .groupBy("text_sha256")
                 .agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size"))
                 .select("text_sha256", F.col("first.doc_id").alias("keep_id"),
                         F.col("first.locator").alias("keep_locator"), "group_size"))
        out = f"{checkpoint}/state-rows"

        def append(batch: DataFrame, batch_id: int) -> None:
            batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        query = (state.writeStream.outputMode("update").option("checkpointLocation", f"{checkpoint}/stream")
                 .trigger(availableNow=True).foreachBatch(append).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = state.schema.add("batch_id", "integer").add("batch", "integer")
    # Built by the JVM: an empty list would start Python workers on every executor that no other step uses.
    no_rows = spark.range(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name != "batch"])
    no_rows.write.mode("overwrite").parquet(f"{out}/batch=-1")
    newest = F.max_by(F.struct("keep_id", "keep_locator", "group_size"), "batch_id").alias("s")
    return (spark.read.schema(schema).parquet(out).groupBy("text_sha256").agg(newest)
            .select("text_sha256", "s.*"))


def keys_path(keys: DataFrame) -> list[str]:
    return sorted({f.rsplit("/", 1)[0] for f in keys.inputFiles()})


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per document, dropped ones too."""
    spark: SparkSession = docs.sparkSession
    keys = materialise(digests(docs), "dedup-keys")
    if not keys.inputFiles():
        state = keys.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.min("locator").alias("keep_locator"),
                                                F.count(F.lit(1)).alias("group_size"))
    else:
        state = keyed_state(keys, scratch_path(spark, "llm-dedup-stream"))
    return verified(docs, keys, state)


def verified(docs: DataFrame, keys: DataFrame, state: DataFrame) -> DataFrame:
    """Give every row its group's keeper, after comparing the full text of each hit with the text that stays."""
    alone = keys.join(state, "text_sha256").filter("group_size = 1") \
        .select("doc_id", "keep_id", "group_size", F.lit(True).alias("kept"), "text_sha256")
    hits = state.filter("group_size > 1").select("text_sha256", "keep_id", "group_size")
    rows = docs.select("doc_id", normalised(F.col("text")).alias("norm")) \
        .withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256)).join(hits, "text_sha256")
    # The one shuffle of texts; what is written are the texts of groups of two or more.
    rows = materialise(rows, "dedup-hits")
    keeper = (rows.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
              .groupBy("text_sha256").agg(F.min("norm").alias("keep_norm")))
    rows = rows.join(keeper, "text_sha256").withColumn("differs", F.col("norm") != F.col("keep_norm"))
    # Two texts under one digest: practically never a row, but then the second text is a group of its own.
    apart = rows.filter("differs").groupBy("text_sha256", "norm") \
        .agg(F.min("doc_id").alias("own_keep"), F.count(F.lit(1)).alias("own_size"))
    lost = apart.groupBy("text_sha256").agg(F.sum("own_size").alias("lost"))
    rows = rows.drop("keep_norm").join(lost, "text_sha256", "left") \
        .join(apart.withColumn("differs", F.lit(True)), ["text_sha256", "norm", "differs"], "left")
    keep = F.when(F.col("differs"), F.col("own_keep")).otherwise(F.col("keep_id"))
    size = F.when(F.col("differs"), F.col("own_size")).otherwise(F.col("group_size") - F.coalesce("lost", F.lit(0)))
    return alone.unionByName(rows.select(
        "doc_id", keep.alias("keep_id"), size.cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256"))
