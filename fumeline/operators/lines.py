"""Dissolve of line geometry: distinct edges, merged chains, single parts.

Edges that coincide count once, and edges that overlap in part are cut at each other's
ends first (:mod:`overlaps`). The output line is a maximal chain: it passes through vertices
where exactly two distinct edges of its group meet, and ends at all others. No step works on a whole
group. Edges and vertices are grouped by coordinates, runs within one input feature
by that feature, and chains are followed by look-ups over ids, so a group holding a
third of all rows spreads like any other rows.

Ids. Groups get a number, which is what the vertex-level shuffles carry. An edge's
number counts on from its feature's, so neighbours on a path differ by one. An edge end is
``2 * edge`` at its head (where the path enters) and ``2 * edge + 1`` at its tail. Edges
joined within a feature form a piece; a piece end is also the arc that leaves the piece
there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fumeline.operators.overlaps import EDGE, partly_overlapping
from fumeline.session import stage, stage_counting, unstage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low 33 bits
_ROW_MASK = (1 << _ROW_BITS) - 1
_POINT = "struct<x:double,y:double>"


def _rows(names: str, *rows: tuple[Column, ...]) -> Column:
    """Several rows out of one, all with the same column names."""
    return F.inline(F.array(
        *[F.struct(*[c.alias(n) for n, c in zip(names.split(), row)]) for row in rows]
    ))


def number_groups(groups: DataFrame) -> DataFrame:
    """Stage one row per group with a number for it in ``_group``."""
    return stage(groups.withColumn("_group", F.monotonically_increasing_id()), "groups")


def with_group(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Put each row's group number on it.

    The groups are staged and ``df`` is a plain scan: adaptive execution splits a hot
    key's rows over tasks only where the join reads both sides straight from their
    shuffles.
    """
    of = [f"_of_{k}" for k in keys]
    numbers = groups.select("_group", *[F.col(k).alias(o) for k, o in zip(keys, of)])
    # The hash comes first: a merge join then sorts by a number that tells keys apart, not by texts.
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, of)],
                  F.xxhash64(*keys) == F.xxhash64(*of))
    return df.join(numbers, same).drop(*of)


def _stage_features(features: DataFrame, groups: DataFrame, keys: list[str], paths: str) -> DataFrame:
    """Stage (_group, line) and number them: (_group, line, feature).

    ``line`` is the feature's paths one after the other, a gap before each. ``feature``
    is the number of the line's first element; those of its others follow. A partition
    takes as many numbers as its rows times its own longest line, so a long line in one
    partition costs no numbers in the others. Zero gets one sign, as grouping gives it: a line
    looks the same whether its edges are the features' own or were cut.
    """
    gap = F.array(F.lit(None).cast(_POINT))
    zero = F.lit(0.0)  # minus zero plus zero is zero
    points = F.transform(F.flatten(F.transform(F.col(paths), lambda p: F.concat(gap, p))), lambda p: F.when(
        p.isNotNull(), F.struct((p["x"] + zero).alias("x"), (p["y"] + zero).alias("y"))))
    line = points.cast(f"array<{_POINT}>")
    rows = with_group(features.select(*keys, paths), groups, keys).select(
        "_group", line.alias("line"), F.monotonically_increasing_id().alias("_row")
    )
    part, row = F.shiftright("_row", _ROW_BITS), F.col("_row").bitwiseAND(_ROW_MASK)
    staged = stage(rows, "features").withColumn("_part", part)
    size = F.greatest(F.size("line"), F.lit(1)).cast("long")
    widths = staged.groupBy("_part").agg(F.max(size).alias("_width"), (F.max(row) + 1).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the input.
    bases = stage(widths.select(F.col("_part"), "_width", F.coalesce(
        F.sum(F.col("_rows") * F.col("_width")).over(earlier), F.lit(0)).alias("_base")), "bases")
    return staged.join(bases, "_part").select(
        "_group", "line", (F.col("_base") + row * F.col("_width")).alias("feature"))


def _edge_rows(staged: DataFrame) -> DataFrame:
    """All vertex pairs of the features' lines with their edge numbers."""
    pairs = F.zip_with("line", F.slice("line", 2, F.greatest(F.size("line"), F.lit(1))),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    exploded = staged.select("_group", "feature", F.posexplode(pairs).alias("_at", "_e"))
    # A pair over a gap has no point at one side.
    return exploded.select(
        "_group", "feature", (F.col("feature") + F.col("_at")).alias("edge"),
        F.col("_e.a.x").alias("hx"), F.col("_e.a.y").alias("hy"),
        F.col("_e.b.x").alias("tx"), F.col("_e.b.y").alias("ty"),
    ).filter("hx is not null and tx is not null and (hx <> tx or hy <> ty)")


def _distinct(rows: DataFrame) -> DataFrame:
    """One row per undirected edge: its two ends in coordinate order, the end id at the first, its feature."""
    ahead = F.expr("hx < tx or (hx = tx and hy < ty)")
    ends = {
        "ax": F.when(ahead, F.col("hx")).otherwise(F.col("tx")),
        "ay": F.when(ahead, F.col("hy")).otherwise(F.col("ty")),
        "bx": F.when(ahead, F.col("tx")).otherwise(F.col("hx")),
        "by": F.when(ahead, F.col("ty")).otherwise(F.col("hy")),
    }
    first_end = F.col("edge") * 2 + F.when(ahead, 0).otherwise(1)
    # Features' numbers do not overlap, so the lowest end is the lowest feature's.
    return rows.groupBy("_group", *[c.alias(n) for n, c in ends.items()]).agg(
        F.min(first_end).alias("end"), F.min("feature").alias("feature")
    )


def _keyed(lines: DataFrame, groups: DataFrame) -> DataFrame:
    """Give every row its group's columns instead of the group's number."""
    return lines.join(groups, "_group").select(
        *[c for c in groups.columns if c != "_group"], *[c for c in lines.columns if c != "_group"]
    )


def distinct_edges(features: DataFrame, keys: list[str], paths: str = "paths") -> DataFrame:
    """The union of each group's lines as edges, coincident ones kept once."""
    groups = number_groups(features.select(*keys).distinct())
    edges, _ = _union_edges(_stage_features(features, groups, keys, paths))
    return _keyed(edges.drop("end", "feature"), groups)


def _union_edges(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges of the union of each group's lines, and the features they are cut out of.

    Edges that others end within are left out, which ends the pieces around them like any
    edge kept elsewhere; what stands for them comes as features of one edge each, with
    numbers after all others.
    """
    edges = stage(_distinct(_edge_rows(staged)), "edges")
    found = partly_overlapping(edges)
    if not found:
        return edges, staged
    gone, new = found
    after = staged.agg(F.max(F.col("feature") + F.greatest(F.size("line"), F.lit(1)))).first()[0]
    # The gap before the line, and its two points.
    numbered = stage(new.withColumn("feature", F.lit(after) + 3 * F.monotonically_increasing_id()), "added")
    a, b = (F.struct(F.col(f"{p}x").alias("x"), F.col(f"{p}y").alias("y")) for p in "ab")
    lines = numbered.select("_group", F.array(F.lit(None).cast(_POINT), a, b).alias("line"), "feature")
    made = numbered.select(*EDGE, ((F.col("feature") + 1) * 2).alias("end"), "feature")
    whole = stage(edges.join(gone, EDGE, "left_anti").select(*EDGE, "end", "feature").unionByName(made), "union")
    unstage(edges, gone, new)
    return whole, staged.unionByName(lines)


def _joints(edges: DataFrame) -> DataFrame:
    """Pairs of edge ends (and their features) meeting at a vertex where nothing else meets."""
    ends = _rows(
        "x y at", (F.col("ax"), F.col("ay"), F.col("end")),
        (F.col("bx"), F.col("by"), F.col("end").bitwiseXOR(1)),
    )
    met = edges.select("_group", "feature", ends).groupBy("_group", "x", "y").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("u"), F.max("at").alias("v"),
        F.min("feature").alias("of_u"), F.max("feature").alias("of_v"),  # in the order of their ends
    )
    return met.filter("n = 2").select("u", "v", "of_u", "of_v")


def _marks(joints: DataFrame) -> DataFrame:
    """What the joints say about each edge: it follows on, or an end leads to another end."""
    u, v = F.col("u"), F.col("v")
    inner = F.expr("u % 2 = 1 and v = u + 1")
    ends = joints.select(inner.alias("inner"), _rows(
        "at to feature", (u, v, F.col("of_u")), (v, u, F.col("of_v"))))
    head = F.col("at") % 2 == 0
    return ends.filter(~F.col("inner") | head).select(
        "feature", F.expr("at div 2").alias("edge"), F.col("inner").alias("follows"),
        F.when(~F.col("inner") & head, F.col("to")).alias("head_to"),
        F.when(~F.col("inner") & ~head, F.col("to")).alias("tail_to"),
    )


def _pieces(edges: DataFrame, joints: DataFrame, staged: DataFrame) -> DataFrame:
    """Runs of edges joined within one feature: (piece, last, head_to, tail_to, points, _group).

    A piece is named by its first edge; ``head_to`` and ``tail_to`` are the ends its
    own ends lead to. What is known about a feature's edges meets in one partition,
    which is no more than that feature's own vertices; the points are then cut out of
    the feature's line.
    """
    told = (
        edges.select("feature", F.expr("end div 2").alias("edge"))
        .unionByName(_marks(joints), allowMissingColumns=True).repartition("feature")
        .groupBy("feature", "edge").agg(
            F.coalesce(F.bool_or("follows"), F.lit(False)).alias("follows"),
            F.max("head_to").alias("head_to"), F.max("tail_to").alias("tail_to"),
        )
    )
    so_far = Window.partitionBy("feature").orderBy("edge").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    begins = F.when(~F.col("follows"), F.col("edge"))
    runs = (
        told.withColumn("piece", F.last(begins, ignorenulls=True).over(so_far))
        .groupBy("feature", "piece").agg(
            F.max("edge").alias("last"), F.max("head_to").alias("head_to"),
            F.max("tail_to").alias("tail_to"),
        )
    )
    start = (F.col("piece") - F.col("feature") + 1).cast("int")
    count = (F.col("last") - F.col("piece") + 2).cast("int")
    return runs.join(staged, "feature").select(
        "piece", "last", "head_to", "tail_to", "_group",
        F.slice("line", start, count).alias("points"),
    )


# A piece that leads nowhere, or back into itself: a whole line as it is.
_ALONE = "coalesce(head_to = last * 2 + 1, head_to is null and tail_to is null)"


_SLICE_PIECES, _SLICE_BYTES = 400_000, 32 << 20  # that a task puts together at once
_SLICED = (
    f"_group long, points array<{_POINT}>, chain long, ring boolean, dist long, backward boolean, "
    "entry0 long, back0 long, entry1 long, back1 long, arc long, other long, edges long, inside long, enters long")


def _jumped(onto: np.ndarray, cost: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The last place of every way along ``onto`` (-1: none), what it costs to get there, and the lowest on the way.

    Ways without an end stop somewhere once all of them has been seen.
    """
    to = np.where(onto < 0, np.arange(len(onto)), onto)
    cost = np.where(onto < 0, 0, cost)
    low = np.minimum(low, low[to])
    for _ in range(len(onto).bit_length() + 1):
        further = to[to]
        if (further == to).all():
            break
        cost, low, to = cost + cost[to], np.minimum(low, low[to]), further
    return to, cost, low


def _joined(table: pa.Table) -> pa.Table:
    """A slice's pieces put together as far as they meet in it (the columns of ``_SLICED``).

    Chains that are whole come as their pieces. Those that lead out of the slice come as their pieces with
    the arc where each way along them begins, and one row per such arc: ``enters`` is the end it leads to at last.
    """
    n = table.num_rows
    ids = {c: table.column(c).fill_null(-1).to_numpy() for c in ("piece", "last", "head_to", "tail_to")}
    arc, enters = np.empty(2 * n, np.int64), np.empty(2 * n, np.int64)
    arc[::2], arc[1::2] = ids["piece"] * 2, ids["last"] * 2 + 1
    enters[::2], enters[1::2] = ids["head_to"], ids["tail_to"]
    edges = np.repeat(ids["last"] - ids["piece"] + 1, 2)
    order = np.argsort(arc)
    at = order[np.minimum(np.searchsorted(arc, enters, sorter=order), 2 * n - 1)]
    # Entering a piece at one end leads to leaving it at the other.
    onto = np.where(arc[at] == enters, at ^ 1, -1)
    cost = np.where(onto < 0, 0, edges[onto])
    last, inside, low = _jumped(onto, cost, arc)
    ring = onto[last] >= 0
    if ring.any():
        # A ring is cut after its lowest arc.
        onto[ring & (arc == low)] = -1
        last, inside, _ = _jumped(onto, cost, arc)
    before = np.full(2 * n, -1)
    before[onto[onto >= 0]] = np.flatnonzero(onto >= 0)
    first, _, _ = _jumped(before, cost, arc)
    out = ~ring & (enters[last] >= 0)
    open_ = out[::2] | out[1::2]
    name = arc[first]
    back = inside[first] - inside
    ahead = name[1::2] < name[::2]  # the way whose name is lower, left by the tail
    own = np.arange(n) * 2 + ahead
    done = np.flatnonzero(~open_)
    whole = pa.table({
        **{c: table.column(c).take(pa.array(done)) for c in ("_group", "points")},
        "chain": pa.array(name[own[done]]), "ring": pa.array(ring[own[done]]), "dist": pa.array(inside[own[done]]),
        "backward": pa.array(~ahead[done])})
    left = np.flatnonzero(open_)
    parts = pa.table({
        **{c: table.column(c).take(pa.array(left)) for c in ("_group", "points")},
        **{f"{c}{k}": pa.array(v[left * 2 + k]) for c, v in (("entry", name), ("back", back)) for k in (0, 1)}})
    begins = np.flatnonzero((first == np.arange(2 * n)) & np.repeat(open_, 2))
    leads = enters[last[begins]]
    ways = pa.table({
        "arc": pa.array(arc[begins]), "other": pa.array(arc[begins ^ 1]), "edges": pa.array(edges[begins]),
        "inside": pa.array(inside[begins]), "enters": pa.array(leads, mask=leads < 0)})
    return pa.concat_tables([whole, parts, ways], promote_options="default")


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in re.split(r", (?=\w+ )", _SLICED)]

    def put_together(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _joined(pa.Table.from_batches(held))
        return iter(table.select(names).combine_chunks().to_batches(max_chunksize=10_000))

    held, rows, size = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= most or size >= _SLICE_BYTES:
            yield from put_together(held)
            held, rows, size = [], 0, 0
    if held:
        yield from put_together(held)


def _ways(begins: DataFrame) -> DataFrame:
    """(arc, inside, next, hop) of ways through slices: the way that follows, and the edges until its first arc's end."""
    onward = begins.select(F.col("other").alias("enters"), F.col("arc").alias("next"), F.col("edges").alias("more"))
    leading = begins.filter("enters is not null").join(onward, "enters")
    nothing = F.lit(None).cast("long")
    return leading.select("arc", "inside", "next", (F.col("inside") + F.col("more")).alias("hop")).unionByName(
        begins.filter("enters is null").select("arc", "inside", nothing.alias("next"), nothing.alias("hop")))


# Look-ups per round. They share one layout of the arcs looked up, so a round with
# three costs less than the two doublings it stands for.
_HOPS = 3


def _hop(step: DataFrame, there: DataFrame) -> DataFrame:
    """Move every pointer on by what its target knew when the round began.

    An arc that has reached its end looks itself up, to no effect: every look-up key
    stays unique, where the end of a long chain would be a hot one.
    """
    done = F.col("done")
    met = step.withColumn("at", F.when(done, F.col("arc")).otherwise(F.col("ptr"))).join(there, "at")
    return met.select(
        "arc", F.when(done, F.col("ptr")).otherwise(F.col("far")).alias("ptr"),
        (F.col("dist") + F.when(done, 0).otherwise(F.col("more"))).alias("dist"),
        F.when(done, F.col("low")).otherwise(F.least("low", "far_low")).alias("low"),
        (done | F.col("far_done")).alias("done"), "was",
    )


def _follow(arcs: DataFrame, left: int) -> tuple[DataFrame, DataFrame | None]:
    """Follow ``next`` from every arc to its chain's last arc, by moving pointers.

    ``left`` is the number of arcs that lead on. Returns (arc, last, dist)
    for arcs that have an end, ``dist`` counting the edges still to come, and (arc, low) for arcs on rings, if there are any,
    ``low`` being the ring's lowest arc.
    Each round extends the reach fourfold, so there are about log4(longest chain) of
    them. The number of open arcs falls in every round until only rings are left; a ring
    is known in full once no lowest arc changes any more.
    """
    arc = F.col("arc")
    found = [arcs.filter("next is null").select(
        "arc", arc.alias("ptr"), F.col("inside").alias("dist")
    )]
    open_ = arcs.filter("next is not null").select(
        "arc", F.col("next").alias("ptr"), F.col("hop").alias("dist"), arc.alias("low"),
    )
    before, changed = left + 1, 1
    while left and (left < before or changed):
        # Pointers may still lead to arcs that ended in any earlier round.
        ends = reduce(DataFrame.unionByName, found).withColumns(
            {"low": F.lit(None).cast("long"), "done": F.lit(True)}
        )
        open_ = open_.withColumn("done", F.lit(False))
        there = ends.unionByName(open_).select(
            arc.alias("at"), F.col("ptr").alias("far"), F.col("dist").alias("more"),
            F.col("low").alias("far_low"), F.col("done").alias("far_done"),
        )
        step = open_.withColumn("was", F.col("low"))
        for _ in range(_HOPS):
            step = _hop(step, there)
        step, seen = stage_counting(
            step, "round",
            left=F.count_if(~F.col("done")),
            changed=F.count_if(~F.col("done") & (F.col("low") != F.col("was"))),
        )
        found.append(step.filter("done").select("arc", "ptr", "dist"))
        open_ = step.filter("not done").select("arc", "ptr", "dist", "low")
        before, left, changed = left, seen["left"], seen["changed"]
    ended = reduce(DataFrame.unionByName, found).withColumnRenamed("ptr", "last")
    return ended, open_.select("arc", "low") if left else None


def _followed(begins: DataFrame) -> DataFrame:
    """(arc, last, dist, ring) of every way through a slice: the last of its chain, and the edges until there."""
    leading = F.count("next")
    arcs, seen = stage_counting(_ways(begins), "arcs", left=leading)
    ended, rings = _follow(arcs, seen["left"])
    every = ended.withColumn("ring", F.lit(False))
    if rings is not None:
        # A ring is cut after its lowest arc and followed like any other chain.
        leads = F.when(F.col("arc") != F.col("low"), F.col("next"))
        cut, seen = stage_counting(
            rings.join(arcs, "arc").select("arc", "inside", leads.alias("next"), "hop"), "cut", left=leading)
        opened, _ = _follow(cut, seen["left"])
        every = every.unionByName(opened.withColumn("ring", F.lit(True)))
    return stage(every, "followed")


def _linked(pieces: DataFrame) -> DataFrame:
    """(_group, chain, ring, dist, backward, points) of pieces that make up longer lines.

    Pieces are range-sorted by where they lie, so most of a chain meets in one slice and is put together
    there. Only chains that go through several slices are followed, as one arc per slice and way.
    Each chain is known both ways; the way whose name is lower is kept.
    """
    place = {f"_{c}": F.col("points")[0][c] for c in "xy"}
    most = _SLICE_PIECES
    near = pieces.select("_group", "piece", "last", "head_to", "tail_to", "points").withColumns(place)
    order = ["_group", *place]
    sliced, seen = stage_counting(
        near.repartitionByRange(*order).sortWithinPartitions(*order).drop(*place).mapInArrow(lambda batches: _slices(batches, most), _SLICED),
        "sliced", left=F.count("arc"))
    columns = ["_group", "chain", "ring", "dist", "backward", "points"]
    whole = sliced.filter("chain is not null").select(*columns)
    if not seen["left"]:
        return whole
    ends = _followed(sliced.filter("arc is not null").select("arc", "other", "edges", "inside", "enters"))
    parts = sliced.filter("entry0 is not null").select("_group", "points", "entry0", "back0", "entry1", "back1")
    for k in (0, 1):
        parts = parts.join(ends.select(
            F.col("arc").alias(f"entry{k}"), F.col("last").alias(f"last{k}"), F.col("dist").alias(f"dist{k}"),
            F.col("ring").alias(f"ring{k}")), f"entry{k}")
    by_head = F.col("last0") < F.col("last1")
    return whole.unionByName(parts.select(
        "_group", F.least("last0", "last1").alias("chain"), F.col("ring0").alias("ring"),
        F.when(by_head, F.col("dist0") - F.col("back0")).otherwise(F.col("dist1") - F.col("back1")).alias("dist"),
        by_head.alias("backward"), "points"))


def _settled(path: Column, ring: Column) -> Column:
    """The same line in a form that depends on its shape alone.

    A ring starts at its lowest vertex. Then the lower end, or the lower neighbour
    of a shared end, comes first.
    """
    n = F.size(path)
    body = F.slice(path, 1, n - 1)
    at = F.array_position(body, F.array_min(body)).cast("int")
    turned = F.concat(
        F.slice(body, at, n), F.slice(body, F.lit(1), at - 1), F.array(F.array_min(body))
    )
    start = F.when(ring, turned).otherwise(path)
    first, last = F.element_at(start, 1), F.element_at(start, -1)
    backward = (last < first) | (
        (last == first) & (F.element_at(start, -2) < F.element_at(start, 2))
    )
    return F.when(backward, F.reverse(start)).otherwise(start)


def _placed_pieces(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pieces that are whole lines, and those that make up longer ones.

    Both come as (_group, chain, ring, dist, points): ``points`` run along the chain and
    ``dist`` edges of it follow after them.
    """
    edges, staged = _union_edges(staged)
    joints = stage(_joints(edges), "joints")
    pieces = stage(_pieces(edges, joints, staged), "pieces")
    unstage(edges, joints, staged)
    alone = pieces.filter(_ALONE).select(
        "_group", F.col("piece").alias("chain"), F.col("head_to").isNotNull().alias("ring"),
        F.lit(0).cast("long").alias("dist"), "points",
    )
    linked = _linked(pieces.filter(f"not {_ALONE}")).select(
        # Chains are named by an arc: below zero, they never meet a lone piece's name.
        "_group", (-1 - F.col("chain")).alias("chain"), "ring", "dist",
        F.when(F.col("backward"), F.reverse("points")).otherwise(F.col("points")).alias("points"),
    )
    return alone, linked


def _lines(staged: DataFrame) -> DataFrame:
    """The chains as (_group, ring, path)."""
    alone, linked = _placed_pieces(staged)
    # Each piece after the first repeats the vertex it joins at.
    parts = F.sort_array(F.collect_list(F.struct((-F.col("dist")).alias("place"), "points")))
    joined = F.flatten(F.transform("parts", lambda p, i: F.when(
        i == 0, p["points"]).otherwise(F.slice(p["points"], 2, F.size(p["points"])))))
    merged = linked.groupBy("_group", "chain", "ring").agg(parts.alias("parts")).select(
        "_group", "ring", joined.alias("line")
    )
    whole = alone.select("_group", "ring", F.col("points").alias("line"))
    return whole.unionByName(merged).select(
        "_group", "ring", _settled(F.col("line"), F.col("ring")).alias("path")
    )


def single_part(
    features: DataFrame, groups: DataFrame, keys: list[str], paths: str = "paths"
) -> DataFrame:
    """Dissolve ``features``: one row per line, with every column of its group.

    ``groups`` has one row per key, usually with attributes of the group.
    """
    groups = number_groups(groups)
    return _keyed(_lines(_stage_features(features, groups, keys, paths)), groups)


def chains(features: DataFrame, keys: list[str], paths: str = "paths") -> DataFrame:
    """Each group's lines merged into maximal chains, one row per chain."""
    return single_part(features, features.select(*keys).distinct(), keys, paths)


def chain_vertices(features: DataFrame, keys: list[str], paths: str = "paths") -> DataFrame:
    """The chains as one row per vertex: (keys, chain, ring, place, x, y).

    ``place`` counts edges from the chain's end. A line of any length stays spread
    over tasks, where :func:`chains` needs each line to fit one row. A ring has its
    first vertex at both ends.
    """
    groups = number_groups(features.select(*keys).distinct())
    alone, linked = _placed_pieces(_stage_features(features, groups, keys, paths))
    rows = alone.unionByName(linked).select(
        "_group", "chain", "ring", "dist", F.size("points").alias("_n"),
        F.posexplode("points").alias("_at", "_p"),
    )
    after = F.col("_n") - 1 - F.col("_at")
    # The vertex two pieces share is the later one's first.
    vertices = rows.filter((after > 0) | (F.col("dist") == 0)).select(
        "_group", "chain", "ring", (F.col("dist") + after).alias("place"),
        F.col("_p.x").alias("x"), F.col("_p.y").alias("y"),
    )
    return _keyed(vertices, groups)
