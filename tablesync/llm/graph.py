"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

__all__ = ["components"]


def components(links: DataFrame, rounds: int = 60, hold: Scratch | None = None) -> DataFrame:
    """(a, b) links to (node, label): the smallest node of the component, for every linked node.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the least of them; the number
    of rounds grows with the logarithm of the longest path. Minima are combined before they move. ``hold`` stages what the rounds write.
    """
    hold = hold or Scratch()

    def signed(df: DataFrame):
        held = hold(df.where("a > b").distinct(), "links")
        row = held.read().agg(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return held, (held.rows, row["s"])

    held, mark = signed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    for _ in range(rounds):
        edges = held.read()
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = hold(large.where("a > b").distinct(), "links").read()
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        small = star.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, (held, mark) = mark, signed(small.unionByName(low.select("a", F.col("m").alias("b"))))
        if mark == before:
            break
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    ends = held.read()
    return ends.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        ends.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
