"""Trigram sets and similarity as built-in array expressions.

Words are maximal runs of letters/digits of the lower-cased text; each word is
padded with two blanks in front and one behind and cut into 3-character
grams; the set of distinct grams is compared by Jaccard ratio.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_SPLIT = r"[^\p{L}\p{N}]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trigrams(col) -> Column:
    words = F.filter(F.split(F.lower(_c(col)), WORD_SPLIT), lambda w: w != F.lit(""))
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(
        padded,
        lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: p.substr(i, F.lit(3))))
    return F.coalesce(F.array_distinct(F.flatten(grams)), F.array().cast("array<string>"))


def shared_count(a_grams, b_grams) -> Column:
    return F.size(F.array_intersect(_c(a_grams), _c(b_grams)))


def similarity_from_sets(a_grams, b_grams) -> Column:
    shared = shared_count(a_grams, b_grams)
    union = F.size(_c(a_grams)) + F.size(_c(b_grams)) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def similarity(a, b) -> Column:
    return similarity_from_sets(trigrams(a), trigrams(b))

