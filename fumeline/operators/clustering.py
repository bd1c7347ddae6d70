"""Vertices that nearly meet are made to meet (R16, tolerance).

Vertices within a radius of each other are linked, and what hangs together is moved to its
lowest vertex if it all fits in the tolerance: no two vertices farther apart than that ever
become one, so no line longer than the tolerance vanishes. What does not fit, a dense run
of vertices for instance, is tried again with half the radius, down to a thousandth of the tolerance; of a
run this joins only what lies much closer than its own spacing.

Vertices are dealt to square cells whose diagonal is the radius, so all of one cell hang
together without being compared. A cell is then compared with those around it, wherever the
borders lie. A vertex stands for all within a sixteenth of a cell's side, so a cell compares no
more than 256 however many it holds. Links are between vertices, never between all pairs of a cell.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.operators.components import components
from fumeline.session import stage, stage_counting, unstage

HALVINGS = 10
_FINE = 16
# Cells ahead that hold vertices within the radius: half of those around, as links go both ways.
_AHEAD = [(dx, dy) for dx in range(3) for dy in range(-2, 3) if (dx, dy) > (0, 0) and max(dx, abs(dy)) < 3 and (dx, abs(dy)) != (2, 2)]


def _links(points: DataFrame, radius: float) -> DataFrame:
    """(a, b): links between (id, x, y) within about the radius, enough to connect them."""
    side = radius / math.sqrt(2)
    cell = {f"c{v}": F.floor(F.col(v) / side) for v in "xy"}
    fine = {f"f{v}": F.floor(F.col(v) / (side / _FINE)) for v in "xy"}
    # Fine cells do not cross the borders of cells.
    placed = points.withColumns({**cell, **fine})
    first = F.min(F.struct("id", "x", "y")).alias("p")
    standing = stage(placed.groupBy("cx", "cy", "fx", "fy").agg(first).select(
        "cx", "cy", "fx", "fy", F.col("p.id").alias("r"), F.col("p.x").alias("x"), F.col("p.y").alias("y")), "standing")
    heads = standing.groupBy("cx", "cy").agg(F.min("r").alias("head"))
    inside = placed.select("id", "cx", "cy", "fx", "fy").join(
        standing.select("cx", "cy", "fx", "fy", "r"), ["cx", "cy", "fx", "fy"]).select(F.col("id").alias("a"), F.col("r").alias("b"))
    to_head = standing.select("cx", "cy", "r").join(heads, ["cx", "cy"]).select(F.col("r").alias("a"), F.col("head").alias("b"))
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _AHEAD])
    ahead = standing.withColumn("s", F.explode(steps)).select(
        (F.col("cx") + F.col("s.dx")).alias("cx"), (F.col("cy") + F.col("s.dy")).alias("cy"), F.col("r").alias("a"),
        F.col("x").alias("ax"), F.col("y").alias("ay"))
    near = ahead.join(standing.select("cx", "cy", F.col("r").alias("b"), "x", "y"), ["cx", "cy"]).filter(
        F.hypot(F.col("x") - F.col("ax"), F.col("y") - F.col("ay")) <= radius).select("a", "b")
    return inside.unionByName(to_head).unionByName(near)


def meeting(points: DataFrame, tolerance: float) -> DataFrame:
    """(x, y, to_x, to_y): where the vertices (x, y) that move go."""
    if not tolerance > 0:
        raise ValueError(f"a tolerance is more than zero, not {tolerance}")
    open_ = stage(points.filter("x is not null and y is not null").select("x", "y").distinct().withColumn(
        "id", F.monotonically_increasing_id()), "points")
    found, radius = [], tolerance
    for _ in range(HALVINGS + 1):
        roots = components(_links(open_, radius))
        # Roots, and vertices without links, are their own.
        grouped = stage(open_.join(roots, "id", "left").select(F.coalesce("root", "id").alias("root"), "id", "x", "y"), "grouped")
        box = grouped.groupBy("root").agg(
            F.min(F.struct("x", "y")).alias("to"),
            F.hypot(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("wide"))
        placed, seen = stage_counting(grouped.join(box, "root"), "placed", left=F.count_if(F.col("wide") > tolerance))
        found.append(placed.filter(F.col("wide") <= tolerance).select(
            "x", "y", F.col("to.x").alias("to_x"), F.col("to.y").alias("to_y")).filter("x <> to_x or y <> to_y"))
        unstage(open_, grouped)
        if not seen["left"]:
            break
        open_ = stage(placed.filter(F.col("wide") > tolerance).select("id", "x", "y"), "points")
        radius /= 2
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def snap(df: DataFrame, tolerance: float, paths: str = "paths") -> DataFrame:
    """``df`` with vertices of ``paths`` that lie within the tolerance of each other moved together."""
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    vertices = rows.select("_row", F.posexplode(paths).alias("_path", "_line")).select(
        "_row", "_path", F.posexplode("_line").alias("_at", "_p")).select(
        "_row", "_path", "_at", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))
    moves = stage(meeting(vertices, tolerance), "moves")
    # Only vertices that move are looked up again, and put into their lines' rows.
    moved = vertices.join(moves, ["x", "y"]).groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct(
        F.struct("_path", "_at"), F.struct(F.col("to_x").alias("x"), F.col("to_y").alias("y"))))).alias("_moves"))

    def path(line, k):
        return F.transform(line, lambda p, i: F.coalesce(F.try_element_at("_moves", F.struct(
            k.alias("_path"), i.alias("_at"))), p))

    return rows.join(moved, "_row", "left").withColumn(
        paths, F.when(F.col("_moves").isNull(), F.col(paths)).otherwise(F.transform(F.col(paths), path))).select(*df.columns)
