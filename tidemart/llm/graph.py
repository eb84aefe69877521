"""Connected components of a graph kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.session import stored


def _directed(edges: DataFrame, name: str) -> DataFrame:
    """Edges from the larger to the smaller end, once each, stored."""
    return stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), name)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every end of an edge ``a, b``: the smallest node it reaches.

    Large and small stars in turn: every node tells its larger neighbours the smallest one it
    knows, then its smaller ones.  Steps grow with the logarithm of the longest path.  Minima
    are aggregates, combined in the input tasks, and the joins can be split by adaptive
    execution, so a node with very many edges does not meet in one task.  Each step is a
    written table, which outlives executors.  Null ends and loops are left out.
    """
    current = _directed(edges, "stars")
    state = _state(current)
    while True:
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("low"))
                       .select(F.col("a").alias("node"), F.least("a", "low").alias("low")), "star-minima")
        large = _directed(both.join(least, both["a"] == least["node"]).where("b > a")
                          .select(F.col("b").alias("a"), F.col("low").alias("b")), "stars")
        least = stored(large.groupBy("a").agg(F.min("b").alias("low"))
                       .select(F.col("a").alias("node"), "low"), "star-minima")
        linked = large.join(least, large["a"] == least["node"]).select(F.col("b").alias("a"), F.col("low").alias("b"))
        current = _directed(linked.unionAll(least.select(F.col("node").alias("a"), F.col("low").alias("b"))), "stars")
        before, state = state, _state(current)
        if state == before:
            roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
