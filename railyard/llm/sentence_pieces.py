"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text gets a leading space (none if it is empty), spaces become the
white-space marker, and of all segmentations into pieces the one with the
largest sum of the vocabulary's scores is taken. A character that no piece
spells becomes its UTF-8 bytes' pieces. Texts are cut before each run of
spaces and around line breaks, where no piece spans the cut (checked when the
vocabulary is loaded, line breaks below), so the best segmentation of the
whole text is that of its parts, however long it is. Each worker keeps the
parts it has met, within a bound, and splits an Arrow batch a slice of its
texts at a time, as the parts of a slice need some ten times its bytes.

Decoding joins the spellings, turns markers into spaces and drops the leading
one. The round trip is exact except that a literal marker character in a text
comes back as a space.

Defined cases: null and empty texts give an empty list, which decodes to an
empty text; null ids in a list and ids outside the vocabulary decode to nothing;
repeated rows are encoded each. Only the text column is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.llm.pieces import MARKER, VOCABULARY, Pieces, best_path, by_length, shared_pieces
from railyard.llm.tables import TEXT_BATCH, python_tasks

PART = re.compile(rb" *[^ \n]+|\n| +")
#: Bytes that a worker keeps of parts and their ids, with what Python needs for each.
CACHE_BYTES, ENTRY_BYTES = 48 << 20, 200
#: Characters of the texts that are split at a time (a longer text alone).
SLICE_CHARS = 1 << 20
RESULT = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])


class Encoder:
    def __init__(self, pieces: Pieces):
        if any(b"\n" in s and s != b"\n" for s in pieces.spelling):
            raise ValueError("a piece spans a line break, so texts cannot be cut at it")
        self.pieces = pieces
        self.known: dict[bytes, bytes] = {}  # ids as 32-bit numbers
        self.held = 0

    def learn(self, parts: Iterable[bytes]) -> None:
        p = self.pieces
        for group, m in by_length(parts):
            paths = best_path(p, m).astype(np.int32)
            counts, plain = (paths >= 0).sum(1), ~(paths == p.unknown).any(1)
            for k, part in enumerate(group):
                ids = paths[k, :counts[k]]
                self.known[part] = found = (ids if plain[k] else self.with_bytes(part, ids)).tobytes()
                self.held += len(part) + len(found) + ENTRY_BYTES

    def with_bytes(self, part: bytes, ids: np.ndarray) -> np.ndarray:
        """Spell each unknown character by its bytes."""
        out, at = [], 0
        for i in ids.tolist():
            if i != self.pieces.unknown:
                out.append(i)
                at += len(self.pieces.spelling[i])
                continue
            n = len(part[at:at + 4].decode(errors="ignore")[:1].encode())
            out += self.pieces.byte_ids[list(part[at:at + n])].tolist()
            at += n
        return np.array(out, np.int32)

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        out, batch, chars = [], [], 0
        for t in texts:
            if batch and chars + len(t or "") > SLICE_CHARS:
                out += self.encode_slice(batch)
                batch, chars = [], 0
            batch.append(t)
            chars += len(t or "")
        return out + self.encode_slice(batch)

    def encode_slice(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [PART.findall((" " + t.replace(MARKER, " ")).encode()) if t else [] for t in texts]
        every = set().union(*split)
        new = every.difference(self.known)
        if self.held + sum(map(len, new)) + len(new) * ENTRY_BYTES > CACHE_BYTES:
            self.known, self.held, new = {}, 0, every
        self.learn(new)
        return [np.frombuffer(b"".join(map(self.known.__getitem__, parts)), np.int32) for parts in split]


def decode(pieces: Pieces, ids: Iterable[int]) -> str:
    spelling, n = pieces.spelling, len(pieces.spelling)
    text = b"".join(spelling[i] for i in ids if i is not None and 0 <= i < n)
    return text.removeprefix(b" ").decode(errors="replace")


def encoder(spark: SparkSession, vocabulary: str = VOCABULARY):
    """A function of columns, text to piece ids. The trie is built once and broadcast (its size is the vocabulary's)."""
    shared = shared_pieces(spark, vocabulary)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker = Encoder(shared.value)
        for texts in batches:
            yield pd.Series(worker.encode(texts), dtype="object")

    return encode


def decoder(spark: SparkSession, vocabulary: str = VOCABULARY):
    """A function of columns, piece ids to text."""
    shared = shared_pieces(spark, vocabulary)

    @F.pandas_udf(T.StringType())
    def decode_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = shared.value
        for lists in batches:
            yield pd.Series([decode(pieces, () if x is None else x.tolist()) for x in lists], dtype="object")

    return decode_ids


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids, n_tokens, round_trip``; the last tells whether decoding gave the text again."""
    spark = docs.sparkSession
    python_tasks(spark, TEXT_BATCH)
    text: Column = F.coalesce(F.col("text"), F.lit(""))
    shared = shared_pieces(spark, vocabulary)

    @F.pandas_udf(RESULT)
    def there_and_back(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker = Encoder(shared.value)  # one function, so that a task has one Python worker
        for texts in batches:
            ids = worker.encode(texts)
            same = [decode(shared.value, x.tolist()) == t.replace(MARKER, " ") for x, t in zip(ids, texts, strict=True)]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype="object"), "round_trip": same})

    return docs.select("doc_id", there_and_back(text).alias("r")) \
        .select("doc_id", "r.ids", F.size("r.ids").cast("long").alias("n_tokens"), "r.round_trip")
