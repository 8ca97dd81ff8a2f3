"""Near-duplicate detection: MinHash with banding, signature verification and connected components.

1. Each whole text becomes its set of word shingles, ``BANDS * ROWS`` minima of
   universal hashes over it, band keys of ``ROWS`` minima each, and a signature
   of one bit per minimum. Texts with equal sets are one node from here on
   (the smallest ``doc_id``), so groups of copies cost one row each.
2. Nodes that share a band key are compared with the key's leader, its node
   with the most neighbours in all bands (of a group of altered copies that is
   one near the original). A pair is confirmed on the full sets; the sizes and
   the signatures rule out nearly all others before.
3. Components of the confirmed links by alternating large-star and small-star.
4. What a star may have missed lies in keys whose nodes are still in different
   components. With up to ``FEW`` nodes, those pairs of a key are compared that
   the sizes and signatures allow. In larger keys nodes are reduced to their
   differences from a leader: two nodes are similar enough exactly if they
   share enough differences, and as a node that is not linked to the leader
   has many, a prefix-filtered join on the rarest of them finds every such
   pair without pairing off the group. Then components are taken again.

With 32 bands of 6, two texts at a similarity of exactly 0.85 share no band with
a probability of 3 in ten million, and fail the signature test (5.5 standard
deviations) with 2 in a hundred million. At 0.80 that many bands of 6 would miss
6 in 100,000; callers with a lower limit ask for more and shorter ones.

Defined cases: texts without words, null ones too, have an empty set, are
linked with nothing and stay; rows that repeat a ``doc_id`` are one node, whose
links are those of the row with the smallest set (by size, then by a digest of
the set) that is not empty, and each has the size of its own set; a
null ``doc_id`` is linked with nothing (component null) and stays; an empty
table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.llm.components import components
from railyard.llm.shingles import Hashes, double_sets, groups, mixed, shingle_sets, word_hashes
from railyard.llm.tables import TEXT_BATCH, materialise, python_tasks
from railyard.session import drop_table

BANDS, ROWS = 32, 6
WORDS = 3
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Nodes of a key up to which its open pairs are compared directly; beyond, by their differences from the leader.
FEW = 32
SALTS = [np.uint64(0), np.uint64(0xD1B54A32D192ED03)]
#: Standard deviations by which the signatures' agreement may fall short of what PERCENT lets expect.
DEVIATIONS = 5.5
SKETCH = {"n_shingles": "long", "set_a": "long", "set_b": "long", "bands": "array<long>", "signature": "array<long>"}


class Rule(NamedTuple):
    """Texts are linked that share ``percent`` of their shingles of ``width`` words; found by ``n_bands`` of ``n_rows`` minima."""

    width: int = WORDS
    percent: int = PERCENT
    n_bands: int = BANDS
    n_rows: int = ROWS

    @property
    def n_hashes(self) -> int:
        return self.n_bands * self.n_rows


def least_agreement(percent: int, n: int = BANDS * ROWS) -> int:
    """Bits of ``n`` in which two signatures must agree: equal minima, and half of the others by chance."""
    p = (1 + percent / 100) / 2
    return int(np.floor(n * p - DEVIATIONS * np.sqrt(n * p * (1 - p))))


def sketches(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``doc_id`` and, for the rule at ``k``, the columns of ``SKETCH`` with ``_k`` behind their names, from one reading of the texts.

    The two set numbers are a 128-bit digest of the set.
    """

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        families = [Hashes.family(rule.n_hashes) for rule in rules]
        salts = [mixed(np.arange(1, rule.n_bands + 1, dtype=np.uint64)) for rule in rules]
        for frame in frames:
            rows: list[list[tuple]] = [[] for _ in rules]
            for group in groups(frame["text"]):
                hashed = word_hashes(group)
                for out, rule, family, salt in zip(rows, rules, families, salts, strict=True):
                    for s in shingle_sets(group, rule.width, hashed):
                        if not len(s):
                            out.append((0, 0, 0, None, None))
                            continue
                        low = family.minima(s)
                        key = salt.copy()
                        for column in low.reshape(rule.n_bands, rule.n_rows).T:
                            key = mixed(key + column)
                        bits = np.packbits((low & np.uint64(1)).astype(np.uint8)).view(np.int64)
                        out.append((len(s), *digest(s), key.view(np.int64), bits))
            yield pd.DataFrame({"doc_id": frame["doc_id"]} | {
                f"{c}_{k}": [r[i] for r in out] for k, out in enumerate(rows) for i, c in enumerate(SKETCH)})

    columns = [f"{c}_{k} {kind}" for k in range(len(rules)) for c, kind in SKETCH.items()]
    return docs.select("doc_id", "text").mapInPandas(sketch, ", ".join(["doc_id long", *columns]))


def near_enough(percent: int, n: int = BANDS * ROWS) -> Column:
    """Sizes and signatures of nodes ``a`` and ``b`` allow the similarity."""
    agree = F.lit(0)
    for k in range(n // 64):
        differ = F.bit_count(F.col("a_signature")[k].bitwiseXOR(F.col("b_signature")[k]))
        agree = agree + (F.lit(64) - differ)
    size = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    return size & (agree >= least_agreement(percent, n))


def digest(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers of a set of hashes."""
    return tuple(int(mixed(s ^ salt).sum(dtype=np.uint64).astype(np.int64)) for salt in SALTS)


def full_sets(ids: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, s, s2``: the whole shingle sets of these documents, as sorted 64-bit hashes and a second hash for each."""

    @F.pandas_udf("struct<s: binary, s2: binary, set_a: bigint, set_b: bigint>")
    def full_set(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [(s[0].tobytes(), s[1].tobytes(), *digest(s[0])) for g in groups(texts) for s in double_sets(g, width)]
            yield pd.DataFrame(rows, columns=["s", "s2", "set_a", "set_b"])

    # The list of ids grows with the corpus, so it is not broadcast, whatever its size here.
    sets = docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id").select("doc_id", full_set("text").alias("f"))
    sets = materialise(sets.select("doc_id", "f.*"), "near-sets")
    # Of rows that repeat an id the one that also gave the sketch.
    odd = sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), chosen(F.octet_length("s"))).filter("rows > 1").drop("rows")
    if odd.isEmpty():
        return sets.select("doc_id", "s", "s2")
    odd = materialise(odd.select("doc_id", "chosen.*"), "near-odd")
    plain = sets.join(odd.select("doc_id"), "doc_id", "left_anti").select("doc_id", "s", "s2")
    same = sets.withColumn("size", F.octet_length("s")).join(odd, ["doc_id", "size", "set_a", "set_b"]).select("doc_id", "s", "s2")
    return plain.unionByName(same.dropDuplicates(["doc_id"]))


def chosen(size: Column) -> Column:
    """Of the rows of an id the one that counts: the smallest set by its size and digest that is not empty."""
    return F.min(F.when(size > 0, F.struct(size.alias("size"), "set_a", "set_b"))).alias("chosen")


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``a, b`` those whose full shingle sets are similar enough."""

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series, left2: pd.Series, right2: pd.Series) -> pd.Series:
        out = []
        for row in zip(left, right, left2, right2, strict=True):
            x, y, x2, y2 = (np.frombuffer(c, np.uint64) for c in row)
            _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
            both = np.count_nonzero(x2[i] == y2[j])  # equal in 128 bits
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype="bool")

    left, right = (sets.select(F.col("doc_id").alias(k), F.col("s").alias(f"{k}_set"), F.col("s2").alias(f"{k}_set2")) for k in "ab")
    return pairs.join(left, "a").join(right, "b").filter(similar("a_set", "b_set", "a_set2", "b_set2")).select("a", "b")


def across_few(rest: DataFrame, percent: int, n: int = BANDS * ROWS) -> DataFrame:
    """Pairs ``a, b`` of one key in different components that sizes and signatures allow."""
    left, right = (rest.select("key", F.col("doc_id").alias(s), F.col("component").alias(f"{s}_component"),
                               F.col("n").alias(f"{s}_n"), F.col("signature").alias(f"{s}_signature")) for s in "ab")
    return left.join(right, "key").filter((F.col("a") < F.col("b")) & (F.col("a_component") != F.col("b_component"))
                                          & near_enough(percent, n)).select("a", "b").distinct()


def across_many(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` in different components of which one is the leader of a key of theirs, or that share enough
    differences from it.

    With ``D`` the differences of a node from the leader and ``slack`` the part
    of two sizes by which similar sets may differ, nodes are similar exactly
    if they share at least ``(|Da| + |Db| - slack * (|a| + |b|)) / 2`` differences.
    That is above 0 unless both are similar to the leader.
    """
    slack = (100 - percent) / (100 + percent)
    members = rest.select("leader", "leader_component", "doc_id", "component", "n").distinct()

    @F.pandas_udf("array<long>")
    def differences(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([np.setxor1d(np.frombuffer(x, np.int64), np.frombuffer(y, np.int64), assume_unique=True)
                          for x, y in zip(left, right, strict=True)], dtype="object")

    apart = members.join(sets, "doc_id").join(sets.select(F.col("doc_id").alias("leader"), F.col("s").alias("leader_s")), "leader") \
        .select("leader", "leader_component", "doc_id", "component", "n", differences("s", "leader_s").alias("d"),
                (F.octet_length("leader_s") / 8).cast("long").alias("leader_n"))
    apart = materialise(apart.withColumn("k", F.size("d")), "near-differences")
    both = F.col("n") + F.col("leader_n")
    led = apart.filter((F.col("component") != F.col("leader_component")) & (100 * (both - F.col("k")) >= percent * (both + F.col("k")))) \
        .select(F.least("leader", "doc_id").alias("a"), F.greatest("leader", "doc_id").alias("b"))
    each = apart.select("leader", "doc_id", "component", F.explode("d").alias("e"))
    # Nodes of different components share no other differences: those of one component alone count as the rarest.
    often = each.groupBy("leader", "e").agg(F.count(F.lit(1)).alias("often"), F.min("component").alias("low"), F.max("component").alias("high")) \
        .filter("low < high").select("leader", "e", "often")
    # The rarest differences first; those beyond the prefix cannot be the first that two similar nodes share.
    ordered = each.drop("component").join(often, ["leader", "e"]).groupBy("leader", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("often", "e"))).alias("ordered")).withColumn("m", F.size("ordered"))
    least_shared = F.greatest(F.lit(1), F.ceil(F.col("k") - slack * (F.col("n") + F.col("n") * 100 / percent) - 1e-6))
    rows = apart.drop("d", "leader_n", "leader_component").join(ordered, ["leader", "doc_id"]).select(
        "leader", "doc_id", "component", "n", "k", "m",
        F.posexplode(F.slice("ordered", F.lit(1), F.greatest(F.lit(0), F.col("m") - least_shared + 1).cast("int"))).alias("at", "p")) \
        .withColumn("e", F.col("p.e")).drop("p")
    rows = materialise(rows, "near-prefixes")
    left, right = (rows.select("leader", "e", *[F.col(c).alias(f"{s}_{c}") for c in ("doc_id", "component", "n", "k", "m", "at")]) for s in "ab")
    share = (F.col("a_k") + F.col("b_k") - slack * (F.col("a_n") + F.col("b_n"))) / 2 - 1e-6
    left_over = F.least(F.col("a_m") - F.col("a_at"), F.col("b_m") - F.col("b_at"))
    return left.join(right, ["leader", "e"]).filter(
        (F.col("a_doc_id") < F.col("b_doc_id")) & (F.col("a_component") != F.col("b_component")) & (left_over >= share)) \
        .select(F.col("a_doc_id").alias("a"), F.col("b_doc_id").alias("b")).unionByName(led).distinct()


def placed(nodes: DataFrame, found: DataFrame | None) -> DataFrame:
    """``nodes`` with the ``component`` of each by the links ``found``: itself, if it has none."""
    if found is None:
        return nodes.withColumn("component", F.col("doc_id"))
    return nodes.join(found, F.col("doc_id") == F.col("node"), "left") \
        .withColumn("component", F.coalesce("component", "doc_id")).drop("node")


def linked(rows: DataFrame, docs: DataFrame, rule: Rule, known: DataFrame | None = None) -> DataFrame:
    """``node, component`` by a rule's links and those ``known`` before, from the rule's sketches.

    Keys whose nodes are all in one component already have nothing to add.
    """
    rows = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["set_a", "set_b", "n_shingles"]
    odd = rows.groupBy("doc_id").agg(F.countDistinct(*same).alias("texts"), chosen(F.col("n_shingles"))).filter("texts > 1")
    odd = materialise(odd.select("doc_id", "chosen"), "near-odd")
    if not odd.isEmpty():
        rows = rows.join(odd, "doc_id", "left").filter(
            "chosen IS NULL OR (n_shingles = chosen.size AND set_a = chosen.set_a AND set_b = chosen.set_b)").drop("chosen")
    nodes = rows.groupBy(*same).agg(F.min("doc_id").alias("node"))
    copies = materialise(rows.join(nodes, same).select("node", "doc_id"), "near-copies")
    sketch = rows.join(nodes.withColumnRenamed("node", "doc_id"), [*same, "doc_id"]).dropDuplicates(["doc_id"]) \
        .select("doc_id", F.col("n_shingles").alias("n"), "signature", "bands")
    sketch = materialise(placed(sketch, known), "near-nodes")
    keys = sketch.select("doc_id", "component", F.explode("bands").alias("key"))
    crowded = keys.groupBy("key").agg(F.count(F.lit(1)).alias("nodes"), F.min("component").alias("low"), F.max("component").alias("high")) \
        .filter("low < high").select("key", "nodes")
    shared = materialise(keys.drop("component").join(crowded, "key"), "near-keys")
    known_by = shared.groupBy("doc_id").agg(F.sum("nodes").alias("neighbours"))
    leads = shared.join(known_by, "doc_id").groupBy("key").agg(F.max(F.struct("neighbours", (-F.col("doc_id")).alias("turned"))).alias("m")) \
        .select("key", (-F.col("m.turned")).alias("leader"))
    shared = materialise(shared.join(leads, "key"), "near-led")
    side = sketch.select("doc_id", "n", "signature")
    stars = shared.filter("leader <> doc_id").select(F.least("leader", "doc_id").alias("a"), F.greatest("leader", "doc_id").alias("b")).distinct()
    left, right = (sketch.select(*[F.col(c).alias(f"{s}_{c}") for c in ("n", "signature", "component")], F.col("doc_id").alias(s)) for s in "ab")
    likely = materialise(stars.join(left, "a").join(right, "b").filter((F.col("a_component") != F.col("b_component"))
                                                                        & near_enough(rule.percent, rule.n_hashes)).select("a", "b"), "near-pairs")
    crowd = shared.filter(F.col("nodes") > FEW).select("doc_id")
    sets = full_sets(nodes_of(likely).unionByName(crowd).distinct(), docs, rule.width)
    links = materialise(confirmed(likely, sets, rule.percent), "near-links")
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")) \
        .unionByName(copies.filter("node <> doc_id").select(F.col("node").alias("u"), F.col("doc_id").alias("v")))
    if known is not None:
        edges = edges.unionByName(known.select(F.col("node").alias("u"), F.col("component").alias("v")))
    found = components(edges)
    now = placed(shared.select("key", "leader", "nodes", "doc_id"), found)
    open_keys = now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
        .filter("low < high").select("key")
    rest = materialise(now.filter("nodes > 2").join(open_keys, "key").join(side, "doc_id"), "near-open")
    # Leaders in one component stand for each other: the one with the most neighbours is the reference of all their keys.
    large = rest.filter(F.col("nodes") > FEW)
    led = placed(large.select(F.col("leader").alias("doc_id")).distinct(), found).join(known_by, "doc_id")
    chief = led.groupBy("component").agg(F.max_by("doc_id", F.struct("neighbours", -F.col("doc_id"))).alias("chief"))
    chiefs = led.join(chief, "component").select(F.col("doc_id").alias("leader"), "chief", F.col("component").alias("leader_component"))
    large = large.join(chiefs, "leader").drop("leader").withColumnRenamed("chief", "leader")
    untried = materialise(across_few(rest.filter(F.col("nodes") <= FEW), rule.percent, rule.n_hashes)
                          .unionByName(across_many(large, sets, rule.percent))
                          .distinct().join(stars, ["a", "b"], "left_anti"), "near-pairs")
    drop_table(sets)
    if untried.isEmpty():
        return found
    sets = full_sets(nodes_of(untried), docs, rule.width)
    more = materialise(confirmed(untried, sets, rule.percent), "near-links")
    drop_table(sets)
    return found if more.isEmpty() else components(edges.unionByName(more.select(F.col("a").alias("u"), F.col("b").alias("v"))))


def near_duplicates(docs: DataFrame, *rules: Rule) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per document, linked by any of the rules; sizes are of the first."""
    rules = rules or (Rule(),)
    if any(rule.n_hashes % 64 for rule in rules):
        raise ValueError("signatures are whole 64-bit words")
    python_tasks(docs.sparkSession, TEXT_BATCH)
    all_rows = materialise(sketches(docs, rules), "near-sketches")
    found = None
    for k, rule in enumerate(rules):
        found = linked(all_rows.select("doc_id", *[F.col(f"{c}_{k}").alias(c) for c in SKETCH]), docs, rule, found)
    out = all_rows.select("doc_id", F.col("n_shingles_0").alias("n_shingles")).join(found, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
