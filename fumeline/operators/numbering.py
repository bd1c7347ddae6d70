"""Dense numbers per group without a window over the group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fumeline.session import stage, unstage

_SLICE_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low 33 bits


def number(
    df: DataFrame, by: list[str], order: list[str | Column], name: str = "ID", staged: bool = False,
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Number rows 1..n within each ``by`` group, in ``order``.

    Rows are staged once, unless they are plain files already (``staged``), as the sort looks
    at them twice. They are range-sorted whole over all partitions, so they are shuffled once and
    a group holding a third of them is spread as widely as its share.
    Each slice then needs only the count of its group's rows in earlier slices. ``by``
    plus ``order`` must be unique for the numbers to be the same on every run. ``order`` may hold
    expressions, which are not shuffled or written; ``drop`` names columns only needed for the order.
    """
    rows = df if staged else stage(df, "rows")
    kept = [c for c in df.columns if c not in drop]
    placed = stage(
        rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).select(
            *kept, F.monotonically_increasing_id().alias("_at")),
        "sorted",
    ).withColumn("_slice", F.shiftright("_at", _SLICE_BITS))
    if not staged:
        unstage(rows)
    held = placed.groupBy(*by, "_slice").agg(
        F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_held")
    )
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_held").over(earlier), F.lit(0)) - F.col("_start") + 1
    # One row per slice and group in it; the staged size decides on a broadcast.
    shifts = stage(
        held.select(*[F.col(c).alias(f"_by_{c}") for c in by],
                    F.col("_slice").alias("_of"), shift.alias("_shift")),
        "shifts",
    )
    same = reduce(
        lambda acc, c: acc & F.col(c).eqNullSafe(F.col(f"_by_{c}")), by,
        F.col("_slice") == F.col("_of"),
    )
    return placed.join(shifts, same).withColumn(name, F.col("_at") + F.col("_shift")).select(*kept, name)
