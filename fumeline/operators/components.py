"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.session import stage, unstage


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every end of a link (a, b) that reaches a smaller one: the smallest it reaches.

    Links are moved until each leads from a node to its root. In a round every node first hands its
    smallest neighbour to its larger ones, then to its smaller ones. A node's smallest neighbour is an
    aggregate with partial results, and the join that brings it back has a row per node on one side,
    so a node with many links is split like any hot key.
    """
    now = stage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "links")
    moved = 1
    while moved:
        both = now.unionByName(now.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("least"))
        # Larger neighbours of u now hang on u's smallest, itself included.
        large = stage(both.filter("low > high").join(least, "high").select(
            F.col("low").alias("high"), F.least("high", "least").alias("low")).distinct(), "large")
        lowest = large.groupBy("high").agg(F.min("low").alias("least"))
        same = F.col("low") == F.col("least")
        small = large.join(lowest, "high").select(
            F.when(same, F.col("high")).otherwise(F.col("low")).alias("high"), F.col("least").alias("low")).distinct()
        after = stage(small, "small")
        # Done when nothing changed: the same links, none of them new.
        moved = _unlike(after, now)
        unstage(now, large)
        now = after
    return now.select(F.col("high").alias("id"), F.col("low").alias("root"))


def _unlike(after: DataFrame, before: DataFrame) -> int:
    """How many links two tables of distinct links do not share."""
    sides = after.withColumn("side", F.lit(1)).unionByName(before.withColumn("side", F.lit(-1)))
    return sides.groupBy("high", "low").agg(F.sum("side").alias("side")).filter("side <> 0").count()
