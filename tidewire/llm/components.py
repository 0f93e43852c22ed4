"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.core import FILES_PER_CORE, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link a node's neighbours (the larger ones, or the smaller ones and
    itself) to the smallest node it knows."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = both.join(low, "u").where("v > u").select(F.col("v").alias("b"), F.col("m").alias("a"))
    else:  # a < b in every edge: b's neighbours are its smaller ones
        down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        out = down.join(low, "u").select(F.col("v").alias("b"), F.col("m").alias("a")).union(
            low.select(F.col("u").alias("b"), F.col("m").alias("a")))
    return out.where("a <> b").select("a", "b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node is either the smallest of its component, linked to all others
    of it, or linked to that one alone."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("up")).union(
        edges.select(F.col("b").alias("node"), F.lit(1).alias("up")))
    loose = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n")).where("up > 0 and n > 1")
    return loose.agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` of every node in ``edges(a, b)``; ``root`` is the
    smallest node of its component.  Every round writes its links, so a lost
    executor repeats one round at most; only a count reaches the driver.  Links that are
    stars already need no round.  The number of rounds grows with the logarithm of the longest path."""
    e = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct(), "links", FILES_PER_CORE)
    for left in range(max_rounds, -1, -1):
        if _settled(e):
            return e.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        if left:
            e = written(_star(_star(e, True), False), "links", per_core=1)
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
