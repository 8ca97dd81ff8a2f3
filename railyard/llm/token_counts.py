"""Token counts by a public tokenizer, as lengths only.

Texts are split at ASCII white space, which the tokenizer drops, so no token
spans a split and the counts of the parts add up to the count of the whole
text however long it is. Each worker keeps the counts of the parts it has met
(bounded); the unknown parts of an Arrow batch go to the library's batch
encoder in groups balanced by bytes. Only the lengths leave the function.

Defined cases: null and empty texts, and those of white space only, have 0
tokens; repeated rows are counted each; a part without any white space is
encoded whole, whatever its length. Only the text column is read.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.llm.tables import python_tasks

VOCABULARY = "word_bpe_49k.json"
#: Bytes of one call of the batch encoder, and entries of the cache of counts (some 100 bytes each).
CALL_BYTES = 1 << 20
CACHE_ENTRIES = 600_000


class PartCounts:
    """Counts of white-space-free parts, encoded once each while the cache lasts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        self.known: dict[bytes, int] = {}

    def learn(self, parts: Iterable[bytes]) -> None:
        for group in by_bytes(parts, CALL_BYTES):
            found = self.encode([p.decode() for p in group], add_special_tokens=False)
            self.known.update(zip(group, (len(x.ids) for x in found), strict=True))

    def count(self, texts: Iterable[str]) -> list[int]:
        split = [(t or "").encode().split() for t in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        self.learn(set().union(*split).difference(self.known))
        return [sum(map(self.known.__getitem__, parts)) for parts in split]


def by_bytes(parts: Iterable[bytes], most: int) -> Iterator[list[bytes]]:
    """Groups of about ``most`` bytes; a longer part is a group of its own."""
    group, held = [], 0
    for p in parts:
        if group and held + len(p) > most:
            yield group
            group, held = [], 0
        group.append(p)
        held += len(p)
    if group:
        yield group


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of a text column. ``vocabulary`` is a file name the workers' tokenizer package resolves."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import public_tokenizers
        counts = PartCounts(str(public_tokenizers.path(vocabulary)))
        for texts in batches:
            yield pd.Series(counts.count(texts), dtype="int64")

    return count(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, limit: int = 2048, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every document."""
    python_tasks(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                       token_count(text, vocabulary).alias("n_tokens")) \
        .withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
