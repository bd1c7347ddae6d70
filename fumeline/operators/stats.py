"""Aggregates: distinct days, group means, summaries, group attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fumeline.session import stage

QUARTILES = (0.25, 0.5, 0.75)


def distinct_count(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Distinct values of a column, a missing value counting as one (A1)."""
    c = F.col(column)
    missing = F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))
    return df.agg((F.count_distinct(c) + missing).alias(name))


def group_mean(df: DataFrame, key: str, value: str, ordered: bool = False) -> DataFrame:
    """Mean of ``value`` per ``key``; missing readings are skipped, missing keys dropped (A2).

    ``ordered`` sorts the result by key, at the price of one more shuffle of the means.
    """
    present = F.when(~F.isnan(value), F.col(value))
    means = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(present).alias(value))
    return means.orderBy(key) if ordered else means


def quantiles(df: DataFrame, value: str, probs: tuple[float, ...] = QUARTILES) -> DataFrame:
    """Exact quantiles with linear interpolation between ranks, as (prob, value).

    Equal values are counted first, so a hot value becomes one row. The counts are
    laid out in value order over many slices; adding up the slices tells which of
    them hold the wanted ranks, and only those are looked through.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sliced = stage(
        counts.repartitionByRange("v").withColumn("slice", F.spark_partition_id()), "slices"
    )
    # One row per slice from here on.
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("slice").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = (
        sliced.groupBy("slice").agg(F.sum("n").alias("held"))
        .withColumn("start", F.coalesce(F.sum("held").over(before), F.lit(0)))
        .withColumn("total", F.sum("held").over(everything))
    )
    place = F.col("prob") * (F.col("total") - 1)
    wanted = (
        totals.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("place", place)
        .withColumn("rank", F.explode(F.array(F.floor("place"), F.ceil("place"))))
        .filter((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("held")))
        .select("slice", "start", "prob", "place", "rank")
        .distinct()
    )
    # At most two rows per probability: staged, so its size is known.
    wanted = stage(wanted, "ranks")
    touched = sliced.join(wanted.select("slice", "start").distinct(), "slice")
    inside = Window.partitionBy("slice").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    runs = touched.withColumn("upto", F.col("start") + F.sum("n").over(inside)).drop("start")
    hit = runs.join(wanted, "slice").filter(
        (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    )
    low, high = F.min("v"), F.max("v")
    share = F.first("place") - F.floor(F.first("place"))
    return hit.groupBy("prob").agg((low + (high - low) * share).alias("value"))


def describe(df: DataFrame, value: str) -> DataFrame:
    """Summary statistics of a column as eight (stat, value) rows (A3).

    Quartiles are exact and come from :func:`quantiles` at every size. A statistic that
    the column has no values for is a row with a null.
    """
    column = stage(df.select(F.col(value).cast("double").alias("v")), "column")
    moments = {
        "count": F.count("v").cast("double"), "mean": F.avg("v"), "std": F.stddev_samp("v"),
        "min": F.min("v"), "max": F.max("v"),
    }
    cells = {"count": None, "mean": None, "std": None, "min": None,
             **{f"{p:.0%}": p for p in QUARTILES}, "max": None}
    summary = column.agg(*[c.alias(n) for n, c in moments.items()])
    nothing = F.lit(None).cast("double")
    rows = summary.select(F.inline(F.array(*[
        F.struct(F.lit(place).alias("place"), F.lit(n).alias("stat"), F.lit(p).cast("double").alias("prob"),
                 (nothing if p else F.col(n)).alias("moment"))
        for place, (n, p) in enumerate(cells.items())
    ])))
    return rows.join(quantiles(column, "v"), "prob", "left").orderBy("place").select(
        "stat", F.coalesce("moment", "value").alias("value"))


def dissolve_attributes(
    df: DataFrame, keys: list[str], first: dict[str, str], mean: dict[str, str],
    order: str = "OBJECTID",
) -> DataFrame:
    """Attributes of each group: FIRST by ``order``, and MEAN.

    ``first`` and ``mean`` map result columns to input columns. Numeric inputs keep
    this a hash aggregate with map-side partial results, so a hot key costs one
    partial row per task.
    """
    picks = [F.min_by(F.col(c), F.col(order)).alias(n) for n, c in first.items()]
    means = [F.avg(F.col(c)).alias(n) for n, c in mean.items()]
    return df.groupBy(*keys).agg(*picks, *means)
