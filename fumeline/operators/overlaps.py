"""Lines that overlap in part: the union of collinear edges, cut at each other's ends.

Every edge has a supporting line. Edges of one group and line are intervals on it; each
point where one of them ends cuts the others there. A sweep along the line, which carries
the farthest end reached so far, tells which stretches between neighbouring points are
covered. No line is swept in one task: points are range-sorted by line and place, every
slice sweeps its own, and what earlier slices reach is carried over as one row per slice
and line, so an edge may reach over many slices.

Edges that no other ends within are left as they are; if there are none else, nothing is
written. Coordinates count as the decimal numbers they are written as. Two edges lie on
one line if they do so exactly; edges that are not parallel to an axis and whose
coordinates take more than 15 digits are only compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fumeline.session import stage, stage_counting, unstage

EDGE = ["_group", "ax", "ay", "bx", "by"]
_LINE = ["_group", "ux", "uy", "c1", "c2"]
_DIGITS = 15
_PRIMES = (2_147_483_647, 2_147_483_629)  # an offset is known by its remainders


def supporting_lines(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ux, uy, c1, c2) of edges (ax, ay, bx, by) by column: equal on one line, and only there.

    (ux, uy) is the direction in lowest terms, the cs are remainders of the offset.
    """
    n = ends.shape[1]
    whole, places, known = np.zeros((4, n), np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    for digits in range(_DIGITS + 1):
        scaled = np.rint(ends * 10.0 ** digits)
        fits = ~known & (np.abs(scaled) < 2 ** 53).all(0) & (scaled / 10.0 ** digits == ends).all(0)
        whole[:, fits], places[fits] = scaled[:, fits].astype(np.int64), digits
        known |= fits
        if known.all():
            break
    dx, dy = whole[2] - whole[0], whole[3] - whole[1]
    step = np.maximum(np.gcd(dx, dy), 1)
    ux, uy = dx // step, dy // step
    offsets = []
    for prime in _PRIMES:
        x, y, a, b = (v % prime for v in (whole[0], whole[1], ux, uy))
        back = np.array([pow(pow(10, -1, prime), d, prime) for d in range(_DIGITS + 1)], np.int64)[places]
        offsets.append((a * y % prime - b * x % prime) % prime * back % prime)
    # Along an axis the other coordinate tells the line, whatever its digits.
    bits = (ends + 0.0).view(np.int64)  # zero has one sign
    for own, other, direction in ((0, 1, (0, 1)), (1, 0, (1, 0))):
        along = ends[own] == ends[own + 2]
        ux[along], uy[along] = direction
        offsets[0][along], offsets[1][along] = bits[own][along], 0
        known |= along
    # The rest are lines of their own.
    ux[~known], uy[~known] = 0, 0
    offsets[0][~known] = (bits[0] * 3 + bits[1])[~known]
    offsets[1][~known] = (bits[2] * 3 + bits[3])[~known]
    return ux, uy, *offsets


_MIXERS = np.random.default_rng(42).integers(0, 1 << 63, len(_LINE), np.uint64) * np.uint64(2) + np.uint64(1)


def _lines_of(batch: pa.RecordBatch) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """A batch's supporting lines, and a hash of each with its group: equal for equal ones."""
    ends = np.stack([batch.column(c).to_numpy() for c in EDGE[1:]]) if batch.num_rows else np.zeros((4, 0))
    columns = supporting_lines(ends)
    mixed = np.zeros(batch.num_rows, np.uint64)
    for values, factor in zip((batch.column("_group").to_numpy(), *columns), _MIXERS):
        mixed = (mixed ^ values.astype(np.int64).view(np.uint64)) * factor
        mixed ^= mixed >> np.uint64(29)
    return columns, mixed.view(np.int64)


def _with_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns, mixed = _lines_of(batch)
        columns = [pa.array(c, pa.int64()) for c in (*columns, mixed)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *_LINE[1:], "hash"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_lines_of(batch)[1], pa.int64())], names=["hash"])


def covered(edges: DataFrame) -> DataFrame:
    """(_LINE, EDGE): the stretches between neighbouring points that edges with a line cover."""
    # Points of a line differ in x, or in y where x is fixed.
    from_, to = (F.when(F.col("ux") != 0, F.col(f"{p}x")).otherwise(F.col(f"{p}y")) for p in "ab")
    begin = edges.select(*_LINE, from_.alias("t"), F.col("ax").alias("x"), F.col("ay").alias("y"), to.alias("reach"))
    end = edges.select(*_LINE, to.alias("t"), F.col("bx").alias("x"), F.col("by").alias("y"),
                       F.lit(None).cast("double").alias("reach"))
    points = begin.union(end).groupBy(*_LINE, "t").agg(
        F.max("x").alias("x"), F.max("y").alias("y"), F.max("reach").alias("reach"))
    slice_of = F.shiftright(F.monotonically_increasing_id(), 33)
    placed = stage(points.repartitionByRange(*_LINE, "t").sortWithinPartitions(*_LINE, "t").withColumn("slice", slice_of), "points")
    held = placed.groupBy(*_LINE, "slice").agg(
        F.max("reach").alias("far"), F.min("t").alias("t"), F.min_by("x", "t").alias("x"), F.min_by("y", "t").alias("y"))
    # A row per slice and line in it.
    slices = Window.partitionBy(*_LINE).orderBy("slice")
    before = F.max("far").over(slices.rowsBetween(Window.unboundedPreceding, -1))
    carried = stage(held.select(
        *_LINE, "slice", before.alias("before"),
        *[F.lead(c).over(slices).alias(f"after_{c}") for c in "txy"]), "carried")
    own = Window.partitionBy(*_LINE, "slice").orderBy("t")
    reach = F.max("reach").over(own.rowsBetween(Window.unboundedPreceding, 0))
    swept = placed.withColumns({"so_far": reach, **{f"next_{c}": F.lead(c).over(own) for c in "txy"}})
    whole = swept.join(carried, [*_LINE, "slice"])
    following = {c: F.when(F.col("next_t").isNotNull(), F.col(f"next_{c}")).otherwise(F.col(f"after_{c}")) for c in "xy"}
    return whole.filter(
        F.coalesce(F.greatest("so_far", "before") > F.col("t"), F.lit(False))).select(
        *_LINE, F.col("x").alias("ax"), F.col("y").alias("ay"), following["x"].alias("bx"), following["y"].alias("by"))


def partly_overlapping(edges: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """(gone, new): the distinct edges (EDGE, ends in order) that others end within, and what stands for them.

    None if there are none.
    """
    # Most edges have their line for themselves. Lines meet by a hash: two of one hash are only looked at for nothing.
    hashes = edges.select(*EDGE).mapInArrow(_hashes, "hash long")
    shared, seen = stage_counting(
        hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "shared", n=F.count(F.lit(1)))
    if not seen["n"]:
        unstage(shared)
        return None
    lined = edges.select(*EDGE).mapInArrow(
        _with_lines, "_group long, ax double, ay double, bx double, by double, ux long, uy long, c1 long, c2 long, hash long")
    some = stage(lined.join(shared, "hash", "left_semi").drop("hash"), "some")
    unstage(shared)
    parts = stage(covered(some).select(*EDGE), "covered")
    gone, seen = stage_counting(some.select(*EDGE).join(parts, EDGE, "left_anti"), "gone", n=F.count(F.lit(1)))
    if not seen["n"]:
        unstage(some, parts, gone)
        return None
    new = stage(parts.join(some.select(*EDGE), EDGE, "left_anti"), "new")
    unstage(some, parts)
    return gone, new
