"""Connected components of links, by alternating large-star and small-star rounds.

Every round is a group-by minimum, which pre-aggregates before it shuffles, and a
join whose hot node is on the splittable side.  Nothing is collected but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour or itself."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return around.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours and itself are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    joined = down.join(least, "a")
    moved = joined.filter(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def _unsettled(edges: DataFrame) -> DataFrame:
    """Nodes that keep the links from being stars: with several smaller neighbours, or with one and a larger one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up = 1 and down = 1)")


def components(edges: DataFrame, scratch: Scratch, label: str = "components") -> DataFrame:
    """``node`` and ``component`` (its smallest member) for every node of a link.

    An empty table has no components.

    Args:
        edges: columns a and b of one ordered type; loops, repeats and either
            direction are fine, rows with a null end are ignored.
        scratch: where each round's links are written.
    """
    downward = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = scratch.save(f"{label}-0", downward)
    round_no = 0
    # once every node but the least links to the least alone, a component is a star
    while not _unsettled(current).isEmpty():
        round_no += 1
        if round_no == MAX_ROUNDS:  # rounds grow with the logarithm of a component's width, so this isn't met
            raise RuntimeError(f"links haven't settled in {MAX_ROUNDS} rounds")
        current = scratch.save(f"{label}-{round_no}", _small_star(_large_star(current)).filter("a <> b").distinct())
        scratch.drop(f"{label}-{round_no - 1}")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
