"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.session import stage, unstage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable from each node that has a link.

    Each round every node passes its smallest neighbour on to its other neighbours,
    first to the larger ones, then among the smaller; the rounds end when every node
    hangs on its root alone. Nodes meet their smallest neighbour in an aggregate with
    partial results and a join of which one side has a row per node, so a hub is split
    like any hot join key. Links that are null, or from a node to itself, are ignored;
    repeated links count once; no links give no rows.
    """
    x, y = F.col(a), F.col(b)
    def mark(table):
        return table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()

    now = stage(
        links.filter(x != y).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct(),
        "links",
    )
    seen = mark(now)
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(
            F.col("v").alias("hi"), F.least("u", "m").alias("lo")).distinct()
        large = stage(large, "large")
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").select(
            F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"),
            F.col("m").alias("lo"),
        ).distinct()
        after = stage(small, "small")
        unstage(now, large)
        now, before, seen = after, seen, mark(after)
        if seen == before:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
