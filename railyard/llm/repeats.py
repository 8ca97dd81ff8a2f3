"""Removing repeated passages: bytes covered by a string of ``LENGTH`` bytes that also starts earlier.

A collection's suffixes in order show which strings repeat. The suffixes of a
large corpus do not go through one order; equal strings are brought together
first, in a way that no string is missed:

1. Every window of ``LENGTH`` bytes has a minimiser, the smallest hash among
   its ``GRAM``-byte grams. Windows in a row with the same minimiser form one
   short string. Equal windows have equal minimisers, so a minimiser that
   occurs once in the corpus proves all its windows unique (most are).
   Strings that repeat themselves show by their minimiser standing in them twice.
2. Equal strings under a minimiser are one class, found by an aggregate over
   digests; all but its earliest occurrence are repeats. A group of many
   copies is one row from here on.
3. Minimisers with several different strings, or one that repeats itself, are dealt into blocks of about
   ``BLOCK`` strings, a very frequent minimiser into several. A block builds the
   Burrows-Wheeler transform and common prefixes of its strings column by
   column (see ``columnwise``), each cut to the bytes around the minimiser that
   another string also has there, as no other window can be shared; runs of suffixes that share ``LENGTH`` bytes are
   equal windows, of which the earliest stays. For minimisers in several
   blocks, the blocks' earliest windows are compared by a digest.
4. The removed ranges of a document are joined into spans and cut out.

"Earlier" is a smaller ``doc_id``, or an earlier start in the same document,
and strings are judged on the input.

Defined cases: a null text is empty; texts below ``LENGTH`` bytes lose nothing; a
null ``doc_id`` comes after all others; rows that repeat a ``doc_id`` are documents
of their own, in the order of a digest of their texts, and rows repeating both
are one document whose result both get; an empty table gives an empty result.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.llm.columnwise import MOST, sorted_suffixes
from railyard.llm.shingles import BASE, mixed, powers
from railyard.llm.tables import materialise, python_tasks
from railyard.session import drop_table

LENGTH = 100
GRAM = 32
#: Strings of a block; its transform holds some 150 bytes for each. Rounds go fastest while it stays in a core's cache.
BLOCK = 2048
#: Windows that are hashed as one array; longer texts are taken piece by piece.
PIECE = 1 << 19
#: The strings digested are shorter than texts whose polynomials modulo 2^64 are known to be equal (1,024 bytes).
DIGEST_BASE = np.uint64(0x9FB21C651E98DF25)
OCCURRENCE = "hash long, digest long, doc long, start long, n int, own boolean"
RESULT = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                       T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
                       T.StructField("kept", T.BinaryType())])


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Scrambled hashes of all grams of the bytes, built up from those of half the length."""
    h, k, done, base = data.astype(np.uint64) + np.uint64(1), 1, 0, np.array([BASE])
    n = len(data) - gram + 1
    out = np.zeros(n, np.uint64)
    while k <= gram:
        if gram & k:
            out = out * base + h[done:done + n]
            done += k
        if 2 * k <= gram:
            h = h[:-k] * base + h[k:]
        base, k = base * base, 2 * k
    return mixed(out)


def least_in_windows(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    k = 1
    low = x
    while 2 * k <= width:
        low, k = np.minimum(low[:-k], low[k:]), 2 * k
    n = len(x) - width + 1
    return np.minimum(low[:n], low[width - k:width - k + n])


def strings_of(texts: list[tuple[int, int, bytes]], length: int, gram: int) -> dict[str, np.ndarray]:
    """The strings of equal minimiser of some pieces ``(document, offset, bytes)``, as columns of ``OCCURRENCE``."""
    sizes = np.array([len(b) for _, _, b in texts], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(b for _, _, b in texts), np.uint8)
    grams, width = gram_hashes(data, gram), length - gram + 1
    low = least_in_windows(grams, width)
    inside = np.zeros(len(low) + 1, bool)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        inside[a:b - length + 1] = True
    inside = inside[:len(low)]
    first = inside.copy()
    first[1:] &= (low[1:] != low[:-1]) | ~inside[:-1]
    first[edges[:-1]] = True
    starts = np.flatnonzero(first)
    stop = inside.copy()
    stop[:-1] &= first[1:] | ~inside[1:]
    n = np.flatnonzero(stop) + 1 - starts
    # Within one text a run is as long as the grams of a window, unless the text repeats itself: cut those.
    if (n > width).any():
        parts = -(-n // width)
        at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, n = np.repeat(starts, parts) + at * width, np.minimum(np.repeat(n, parts) - at * width, width)
    # Only a string in which the smallest hash stands twice can hold a window twice.
    shown = np.concatenate([np.zeros(width - 1, np.uint64), np.where(inside, low, np.uint64(0)), np.zeros(width - 1, np.uint64)])
    smallest = np.flatnonzero(~least_in_windows(~shown, width) == grams)
    again = (grams[smallest[1:]] == grams[smallest[:-1]]) & (np.diff(smallest) <= width)
    one, two = smallest[:-1][again], smallest[1:][again]
    own = np.searchsorted(two, starts + n + width - 2, "right") > np.searchsorted(one, starts, "left")
    up = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(DIGEST_BASE, len(data)))])
    back = powers(np.uint64(pow(int(DIGEST_BASE), -1, 1 << 64)), len(data) + 1)
    digest = mixed((up[starts + n + length - 1] - up[starts]) * back[starts])
    of = np.searchsorted(edges, starts, "right") - 1
    docs, offsets = (np.array([t[k] for t in texts], np.int64) for k in (0, 1))
    return {"hash": low[starts].view(np.int64), "digest": digest.view(np.int64), "doc": docs[of],
            "start": offsets[of] + starts - edges[of], "n": n.astype(np.int32), "own": own}


def occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py()
                for at in range(0, max(0, len(data) - length + 1), PIECE):
                    group.append((doc, at, data[at:at + PIECE + length - 1]))
                    held += len(group[-1][2])
                    if held >= PIECE:
                        yield pa.RecordBatch.from_pydict(strings_of(group, length, gram))
                        group, held = [], 0
            if group:
                yield pa.RecordBatch.from_pydict(strings_of(group, length, gram))

    return docs.select("doc", "bytes").mapInArrow(find, OCCURRENCE)


def numbered(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, bytes``: ``doc`` orders the documents and tells rows with one ``doc_id`` but different texts apart."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes"))
    odd = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        return rows.select(F.col("doc_id").alias("doc"), "doc_id", "bytes")
    tagged = rows.withColumn("tag", F.sha2("bytes", 256))
    # A number that grows along one distributed sort, whatever the ids are and however many rows have none.
    order = tagged.select(F.col("doc_id").alias("d"), F.col("tag").alias("t")).distinct().orderBy(F.asc_nulls_last("d"), "t")
    order = materialise(order.withColumn("doc", F.monotonically_increasing_id()), "repeat-order")
    return tagged.join(order, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tag") == F.col("t"))).select("doc", "doc_id", "bytes")


def longest_shared(group: np.ndarray, context: np.ndarray) -> np.ndarray:
    """For each row of bytes how many it has in front in common with another row of its group; 0 without another."""
    key = np.column_stack([group.astype(">u8")[:, None].view(np.uint8), context, np.zeros((len(group), -context.shape[1] % 8), np.uint8)])
    order = np.lexsort(np.ascontiguousarray(key).view(">u8").T[::-1])
    differ = key[order[1:], :8 + context.shape[1]] != key[order[:-1], :8 + context.shape[1]]
    common = np.maximum(np.where(differ.any(1), differ.argmax(1), differ.shape[1]) - 8, 0)
    out = np.zeros(len(group), np.int64)
    out[order[1:]] = common
    out[order[:-1]] = np.maximum(out[order[:-1]], common)
    return out


def shared_parts(strings: list[bytes], whole: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each string, from and to, in which all its windows lie that another string can have too.

    Equal windows have their minimiser at the same place. So a string shares no
    more than the bytes before and behind its minimiser that the other strings
    of this minimiser have there. Where a minimiser stands twice in a string, and for those of ``whole``,
    strings keep their full length.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    edges = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(strings), np.uint8)
    of = np.repeat(np.arange(len(strings)), sizes)
    hashes = np.append(gram_hashes(data, gram), np.zeros(gram - 1, np.uint64))
    hashes[np.arange(len(data)) > (edges + sizes - gram)[of]] = np.iinfo(np.uint64).max
    least = np.minimum.reduceat(hashes, edges)
    stands = np.flatnonzero(hashes == least[of])
    first = np.unique(of[stands], return_index=True)[1]
    at = stands[first] - edges
    twice = np.diff(np.append(first, len(stands))) > 1
    whole = whole | np.isin(least, least[twice])
    reach = np.arange(length - gram)
    before, behind = at[:, None] - 1 - reach, at[:, None] + gram + reach
    left = np.where(before >= 0, data[edges[:, None] + np.maximum(before, 0)], 255)
    right = np.where(behind < sizes[:, None], data[edges[:, None] + np.minimum(behind, sizes[:, None] - 1)], 255)
    begin = np.maximum(0, at - longest_shared(least, left.astype(np.uint8)))
    end = np.minimum(sizes, at + gram + longest_shared(least, right.astype(np.uint8)))
    return np.where(whole, 0, begin), np.where(whole, sizes, end)


def repeats_in_block(length: int, gram: int):
    """From a block's strings the ranges to remove, and the earliest windows of minimisers that lie in several blocks."""

    def search(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates(["doc", "start"])  # a document that two rows repeat
        strings = [bytes(b) for b in block["string"]]
        begin, end = shared_parts(strings, block["split"].to_numpy(bool), length, gram)
        left = np.flatnonzero(end - begin >= length)
        strings = [strings[i][begin[i]:end[i]] for i in left]
        block = block.iloc[left].assign(start=block["start"].to_numpy()[left] + begin[left])
        string, start, common = sorted_suffixes(strings)
        sizes = np.array([len(s) for s in strings], np.int64)
        run = np.cumsum(common < length)
        window = sizes[string] - start >= length
        string, start, run = string[window], start[window], run[window]
        doc, begin = block["doc"].to_numpy()[string], block["start"].to_numpy()[string] + start
        order = np.lexsort((begin, doc, run))
        string, start, run, doc, begin = (x[order] for x in (string, start, run, doc, begin))
        head = np.ones(len(run), bool)
        head[1:] = run[1:] != run[:-1]
        # Repeats next to each other are one range.
        order = np.lexsort((begin[~head], doc[~head]))
        d, b = doc[~head][order], begin[~head][order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (b[1:] > b[:-1] + length)
        last = np.append(np.flatnonzero(new)[1:] - 1, len(d) - 1)[:new.sum()]
        removed = pd.DataFrame({"doc": d[new], "start": b[new], "stop": b[last] + length, "window": None})
        shared = head & block["split"].to_numpy()[string]
        digests = [hashlib.sha256(strings[s][k:k + length]).digest()[:16] for s, k in zip(string[shared], start[shared], strict=True)]
        heads = pd.DataFrame({"doc": doc[shared], "start": begin[shared], "stop": begin[shared] + length, "window": digests})
        return pd.concat([removed, heads]) if len(heads) else removed

    return search


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc, start, stop``: ranges of bytes to remove, which may overlap."""
    if 2 * length - gram + 1 > MOST:
        raise ValueError("strings of equal minimiser would be too long")
    found = materialise(occurrences(docs, length, gram), "repeat-strings")
    repeated = found.groupBy("hash").agg(F.count(F.lit(1)).alias("k"), F.max("own").alias("o")).filter("k > 1 OR o").select("hash")
    candidates = materialise(found.join(repeated, "hash"), "repeat-candidates")
    drop_table(found)
    same = ["hash", "digest", "n"]
    classes = materialise(candidates.groupBy(*same).agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("k"),
                                                              F.max("own").alias("own")),
                          "repeat-classes")
    copies = candidates.join(classes.filter("k > 1").select(*same, "first"), same) \
        .filter((F.col("doc") != F.col("first.doc")) | (F.col("start") != F.col("first.start"))) \
        .select("doc", "start", (F.col("start") + F.col("n") + (length - 1)).alias("stop"))
    several = classes.groupBy("hash").agg(F.count(F.lit(1)).alias("strings"), F.max("own").alias("own")).filter("strings > 1 OR own").drop("own")
    contested = materialise(classes.join(several, "hash").select("hash", "first.doc", "first.start", "n", "strings"), "repeat-contested")
    blocks = max(1, -(-contested.count() // BLOCK))
    parts = F.ceil(F.col("strings") / F.lit(float(BLOCK)))
    placed = contested.select(
        "doc", "start", "n", (F.col("strings") > BLOCK).alias("split"), F.pmod(F.xxhash64("hash"), F.lit(blocks)).alias("block"),
        F.pmod(F.xxhash64("doc", "start"), parts).alias("part"))
    cut = F.substring("bytes", (F.col("start") + 1).cast("int"), (F.col("n") + (length - 1)).cast("int"))
    strings = placed.join(docs.select("doc", "bytes"), "doc") \
        .select("block", "part", "doc", "start", "split", cut.alias("string"))
    windows = materialise(strings.groupBy("block", "part").applyInPandas(
        repeats_in_block(length, gram), "doc long, start long, stop long, window binary"), "repeat-windows")
    heads = windows.filter("window IS NOT NULL")
    earliest = heads.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"))
    later = heads.join(earliest, "window").filter((F.col("doc") != F.col("first.doc")) | (F.col("start") != F.col("first.start")))
    return copies.unionByName(windows.filter("window IS NULL").drop("window")).unionByName(later.select("doc", "start", "stop"))


@F.pandas_udf(RESULT)
def cut_out(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, starts, stops in batches:
        rows = []
        for data, a, b in zip(texts, starts, stops, strict=True):
            spans = [] if a is None else joined(a, b)
            kept, at = [], 0
            for begin, end in spans:
                kept.append(data[at:begin])
                at = end
            kept = b"".join([*kept, data[at:]])
            rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def joined(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that overlap or touch made one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts.tolist(), stops.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the remaining bytes) for every document."""
    python_tasks(docs.sparkSession)
    rows = numbered(docs)
    ranges = repeated_ranges(rows, length, gram).groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("r"))
    out = rows.join(ranges, "doc", "left").select("doc_id", cut_out("bytes", F.col("r.start"), F.col("r.stop")).alias("c"))
    return out.select("doc_id", "c.*")
