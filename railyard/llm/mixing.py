"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words: the weights share the wanted total, a
target stops at ``max_copies`` times its source's size, and the excess goes to
the other sources by weight until none is above its stop. Within a source a
document is expected ``target / source size`` times (relative to its own
weight, if a weight column is named): the whole part is taken for certain, and
the rest is an inclusion probability ``p``. Documents are ranked by their
random odds over their inclusion odds, ``(u / (1-u)) / (p / (1-p))``, and the
sample is the front of that ranking whose words come nearest what is still
missing, so its size is fixed and not left to chance.

``u`` comes from a digest of the seed and ``doc_id``, so reruns and other
partitionings agree. The ranking is never sorted as a whole: documents fall
into ``BINS`` ranges of their odds, sizes are summed per range, and only the
one range per source in which the sample ends is put in order.

Defined cases: a null text has size 0 and takes 0 words; a null source is a
source of its own, last in order; a null ``doc_id`` takes part like the text
"null"; repeated rows share one random number and are ordered by size and
then arbitrarily, which leaves the multiset of results the same; an empty
table gives an empty result. Sources whose documents are all empty have target
0. Only the columns used are read, so others of any name cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from railyard.llm.tables import materialise, words

#: Ranges of the odds per source. The one in which a sample ends is sorted in one task, so it holds about a
#: 1/BINS part of its source.
BINS = 16384


def random_unit(doc_id: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from the first 52 bits of a digest of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(4503599627370496.0)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_copies: float) -> DataFrame:
    """``source, source_size, target`` from the sum of sizes per source.

    The table has a row per source (small whatever the corpus), so its
    ordering may be one task. Sources fill up in the order of their size per
    weight: the first ones that cannot take their part stop at ``max_copies``
    times their size, all others get the same amount per unit of weight.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("n") % len(weights) + 1).cast("int"))
    stop = F.col("source_size") * F.lit(float(max_copies))
    ranked = by_source.withColumn("n", F.row_number().over(order) - 1).withColumn("weight", weight) \
        .withColumn("stop", stop)
    fill = W.orderBy(F.col("stop") / F.col("weight"), "n")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    filled = ranked.withColumn("stops_before", F.coalesce(F.sum("stop").over(before), F.lit(0.0))) \
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0))) \
        .withColumn("all_weight", F.sum("weight").over(W.partitionBy())) \
        .withColumn("wanted", F.sum("source_size").over(W.partitionBy()) * F.lit(float(share)))
    level = (F.col("wanted") - F.col("stops_before")) / (F.col("all_weight") - F.col("weight_before"))
    # The level at which the remaining sources share the rest; the first source that stays below its stop sets it.
    levels = filled.withColumn("level", level) \
        .withColumn("open", F.col("level") * F.col("weight") < F.col("stop"))
    final = levels.withColumn("water", F.min(F.when(F.col("open"), F.struct("stops_before", "level"))).over(W.partitionBy()))
    target = F.when(F.col("water").isNull(), F.col("stop")) \
        .otherwise(F.least(F.col("stop"), F.col("water.level") * F.col("weight")))
    return final.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def pareto_sample(rows: DataFrame, seed: str) -> DataFrame:
    """Add ``copies``: whole ones for certain, and one more for the front of the Pareto ranking.

    ``rows`` has ``doc_id, source, size, expected`` (copies, 0 or more) and
    ``missing`` (words of its source beyond the whole copies).
    """
    whole = F.floor("expected").cast("long")
    odds = F.col("u") / (1.0 - F.col("u"))
    drawn = rows.withColumn("whole", whole).withColumn("p", F.col("expected") - F.col("whole")) \
        .withColumn("u", random_unit(F.col("doc_id"), seed)) \
        .withColumn("q", F.when(F.col("p") > 0, odds / (F.col("p") / (1.0 - F.col("p"))))) \
        .withColumn("bin", F.floor(F.col("q") / (1.0 + F.col("q")) * F.lit(BINS)))
    in_play = drawn.filter("p > 0 AND size > 0")
    bins = in_play.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"), F.first("missing").alias("missing")) \
        .withColumn("before", F.sum("bin_size").over(W.partitionBy("source").orderBy("bin")) - F.col("bin_size"))
    # The range in which the missing words are reached; all earlier ones are taken whole.
    last = bins.filter("before < missing AND missing <= before + bin_size") \
        .groupBy("source").agg(F.min_by(F.struct("bin", "before"), "bin").alias("end")) \
        .select(F.col("source").alias("end_source"), F.col("end.bin").alias("end_bin"), F.col("end.before").alias("before"))
    joined = drawn.join(materialise(last, "mix-ends"), F.col("source").eqNullSafe(F.col("end_source")), "left") \
        .withColumn("plays", (F.col("p") > 0) & (F.col("size") > 0))
    inside = F.col("plays") & (F.col("bin") == F.col("end_bin"))
    at_end = joined.filter(inside).withColumn(
        "upto", F.col("before") + F.sum("size").over(W.partitionBy("source").orderBy("q", "doc_id", "size")
                                                    .rowsBetween(W.unboundedPreceding, 0)))
    at_end = at_end.withColumn("extra", (F.col("upto") - F.col("size") / 2.0 <= F.col("missing")).cast("long"))
    # Without an end range every document in play is needed (its source misses more words than they hold), or none.
    rest = joined.filter(~F.coalesce(inside, F.lit(False))).withColumn(
        "extra", (F.col("plays") & F.when(F.col("end_bin").isNull(), F.col("missing") > 0)
                  .otherwise(F.col("bin") < F.col("end_bin"))).cast("long"))
    both = rest.unionByName(at_end.drop("upto"))
    return both.withColumn("copies", F.col("whole") + F.coalesce("extra", F.lit(0))) \
        .drop("whole", "p", "u", "q", "bin", "end_source", "end_bin", "before", "plays", "extra")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_copies: float = 2.0,
        seed: str = "mix", carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` and the ``carry`` columns as ``carry_...``, one row per document.

    ``weights`` repeat over the sources in code-point order, null last;
    ``share`` is the wanted total as a part of all words.
    """
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"),
                        *[F.col(c).alias(f"carry_{c}") for c in carry])
    if not carry:
        sized = materialise(sized, "mix-sizes")
    # Written out, so that its true size is known when the join is planned: Spark broadcasts it only if it is small.
    targets = materialise(source_targets(sized, weights, share, max_copies).withColumnRenamed("source", "of"), "mix-targets")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("expected", expected) \
        .withColumn("missing", F.col("target") - F.floor("expected") * F.col("source_size"))
    out = pareto_sample(rows, seed)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "copies", *[f"carry_{c}" for c in carry])
