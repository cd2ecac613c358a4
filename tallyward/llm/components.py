"""Connected components of a graph of any size: alternating stars, each step a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyward.llm.common import stored


def _towards_least(edges: DataFrame, reverse: bool) -> DataFrame:
    """Connect the neighbours of each node to the least of them (and of the node itself).

    ``reverse``: each node sees all its neighbours and moves the larger ones; otherwise it sees the smaller ones and moves them and
    itself. Both keep the components and together make all paths short.
    """
    seen = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if reverse else edges
    # A table of its own, so that the join reads it as it lies and adaptive execution can cut the edges of a node with very many.
    least = stored(seen.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")), "least-neighbours")
    joined = seen.join(least, "a")
    if reverse:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        others = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = others.union(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def _noted(edges: DataFrame, purpose: str) -> tuple[DataFrame, dict]:
    """The edges, stored, with their number and the sum of their hashes, taken in the same pass."""
    seen = Observation()
    hashes = F.sum((F.xxhash64("a", "b") % 2**31).cast("decimal(38,0)"))
    table = stored(edges.observe(seen, F.count(F.lit(1)).alias("edges"), hashes.alias("hashes")), purpose)
    return table, dict(seen.get)


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """``node``, ``root`` for each node of the edges ``a``, ``b`` (longs): the root is the least node that it is connected to."""
    larger_first = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, state = _noted(larger_first, purpose)
    before = None
    while state["edges"] and state != before:
        before = state
        current, state = _noted(_towards_least(_towards_least(current, True), False), purpose)
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
