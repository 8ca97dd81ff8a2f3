"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.tables import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(neighbours: DataFrame, keep) -> DataFrame:
    """Link each node's kept neighbours to the smallest node of its neighbourhood, itself included.

    The minimum is an aggregate (combined before the shuffle) joined back, so
    a node with very many neighbours is not gathered anywhere.
    """
    low = neighbours.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return neighbours.join(low, "u").filter(keep).select(F.col("v").alias("u"), F.col("low").alias("v")) \
        .filter("u <> v").distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest of its neighbourhood."""
    return _star(_both_ways(edges), F.col("v") > F.col("u"))


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    smaller = down.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return smaller.unionByName(low.select("u", F.col("low").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge, from edges ``u, v`` (long).

    The component is its smallest node. Each round is written to the shared
    checkpoint folder; the rounds end when one changes nothing, and all edges
    then point from a node to the smallest node of its component. Nulls and
    links of a node to itself are left out; no edges give no rows.
    """
    now = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    while True:
        after = materialise(small_star(large_star(now)), "edges")
        changed = after.join(now, ["u", "v"], "left_anti").limit(1).count() or now.join(after, ["u", "v"], "left_anti").limit(1).count()
        now = after
        if not changed:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
