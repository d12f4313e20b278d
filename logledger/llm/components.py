"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than u is linked to the smallest of u and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them (edges hold a < b)."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    others = edges.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return others.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (columns a, b).

    ``component`` is the smallest node that can be reached.  Loops, repeated
    and reversed edges are allowed; rows with a null end are ignored; an empty
    table gives an empty result.  Minima are aggregated before the shuffle and
    hot nodes only meet joins that Spark can split; each round is
    checkpointed, so a lost executor costs one round at most.
    """
    now = (edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
           .filter("a <> b").distinct().checkpoint())
    before, state = None, _state(now)
    while state != before and state[0]:
        now = _small_star(_large_star(now)).checkpoint()
        before, state = state, _state(now)
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("a").alias("component")))
