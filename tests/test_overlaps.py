"""Lines that overlap in part, against the union of intervals on each supporting line."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from fumeline.operators import overlaps
from fumeline.operators.lines import chain_vertices, chains, distinct_edges
from tests import brute
from tests.test_lines import chain_sets, vertex_sets


def union_of(paths):
    """The edges of the union: on each line, neighbouring points that some edge covers."""
    lines = defaultdict(set)
    for a, b in brute.drawn_edges(paths):
        lines[brute.line_of(a, b)].add((a, b))
    out = set()
    for edges in lines.values():
        points = sorted({p for e in edges for p in e})
        out |= {(p, q) for p, q in zip(points, points[1:]) if any(a <= p and q <= b for a, b in edges)}
    return out


def as_float(paths):
    return [[(float(x), float(y)) for x, y in p] for p in paths]


def edge_sets(df):
    out = defaultdict(set)
    for r in df.collect():
        out[r["g"]].add(((r["ax"], r["ay"]), (r["bx"], r["by"])))
    return out


SHAPES = {
    "one over two": [[(0, 0), (2, 0)], [(0, 0), (1, 0)], [(1, 0), (2, 0)]],
    "staggered": [[(0, 0), (2, 0)], [(1, 0), (3, 0)], [(5, 0), (4, 0)], [(3, 0), (4, 0)]],
    "inside": [[(0, 0), (9, 9)], [(3, 3), (4, 4)]],
    "touching only": [[(0, 0), (1, 1)], [(1, 1), (2, 2)]],
    "parallel": [[(0, 0), (4, 0)], [(1, 1), (3, 1)]],
    "upright": [[(5, 0), (5, 10)], [(5, 8), (5, 2)], [(5, 9), (5, 12)]],
    "doubled back": [[(0, 0), (4, 0), (2, 0), (6, 0)]],
    "a bend that overlaps": [[(0, 0), (4, 2), (8, 0)], [(2, 1), (6, 3)], [(4, 2), (6, 1), (7, 5)]],
    "ring with a doubled side": [[(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 0), (3, 0)]],
    "tenths": [[(0.1, 0.1), (0.7, 0.7)], [(0.3, 0.3), (0.9, 0.9)]],
    "degrees": [[(-117.123456, 34.000001), (-117.123056, 34.000801)], [(-117.123256, 34.000401), (-117.122856, 34.001201)]],
    "side by side of another": [[(0, 0), (6, 0)], [(3, 0), (3, 5)]],
}


def test_shapes(features):
    rows = [(name, [path]) for name, paths in SHAPES.items() for path in paths]
    rows += [(f"{name}, one feature", paths) for name, paths in SHAPES.items()]
    want = {g: union_of(as_float([p for n, ps in rows if n == g for p in ps])) for g, _ in rows}
    assert edge_sets(distinct_edges(features(rows), ["g"])) == want
    whole = {g: brute.chains_of([list(e) for e in edges]) for g, edges in want.items()}
    assert chain_sets(chains(features(rows), ["g"])) == whole
    assert vertex_sets(chain_vertices(features(rows), ["g"])) == whole
    assert whole["one over two"] == {(False, ((0, 0), (1, 0), (2, 0)))}


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(features, seed):
    """Total length is the measure of the union."""
    rng = random.Random(seed)
    rows = []
    for g in "ab":
        for _ in range(150):
            x, y, (dx, dy), n = rng.randrange(8), rng.randrange(8), rng.choice([(1, 0), (0, 1), (1, 1), (2, -1)]), rng.randint(1, 5)
            path = [(x, y), (x + n * dx, y + n * dy)]
            if rng.random() < 0.3:
                path.append((path[-1][0] + rng.randint(-2, 2), path[-1][1] + rng.randint(-2, 2)))
            rows.append((g, [path]))
    want = {g: union_of(as_float([p for n, ps in rows if n == g for p in ps])) for g in "ab"}
    assert edge_sets(distinct_edges(features(rows), ["g"])) == want
    got = chain_sets(chains(features(rows), ["g"]))
    assert got == {g: brute.chains_of([list(e) for e in edges]) for g, edges in want.items()}
    for g, lines in got.items():
        assert sum(brute.length(line) for _, line in lines) == pytest.approx(sum(brute.length(e) for e in want[g]))


def test_features_without_lines_keep_their_numbers(features):
    """The features added for the union do not take the number of an empty one."""
    rows = [("a", [[(0, 0), (2, 0)], [(1, 0), (3, 0)]]), ("a", [])]
    for n in range(3):
        got = chain_sets(chains(features(rows + [("a", [])] * n).coalesce(1), ["g"]))
        assert got == {"a": {(False, ((0, 0), (1, 0), (2, 0), (3, 0)))}}


def test_long_edge_over_many_slices(spark, features):
    """One edge covers thousands of others, whose points lie in many slices of the sweep."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        rows = [("a", [[(0, 0), (3000, 0)]])] + [("a", [[(k, 0), (k + 1, 0)]]) for k in range(0, 3000, 3)]
        got = chain_sets(chains(features(rows), ["g"]))["a"]
        assert len(got) == 1
        (_, line), = got
        assert line[0] == (0, 0) and line[-1] == (3000, 0) and len(line) == 2001
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_supporting_lines():
    rng = np.random.default_rng(1)
    made = rng.integers(-40, 40, (4, 4000)) / rng.choice([1.0, 10.0, 1000.0], 4000)
    first = (made[0] < made[2]) | ((made[0] == made[2]) & (made[1] < made[3]))
    ends = made[:, first]
    keys = list(zip(*supporting(ends)))
    want = [brute.line_of((a, b), (c, d)) for a, b, c, d in ends.T.tolist()]
    by_key, by_line = defaultdict(set), defaultdict(set)
    for k, w in zip(keys, want):
        by_key[k].add(w)
        by_line[w].add(k)
    assert all(len(v) == 1 for v in by_key.values()) and all(len(v) == 1 for v in by_line.values())
    # Seventeen digits: along an axis as any other, else alone.
    odd = np.array([[1 / 3, 0.0, 1 / 3, 1.0], [1 / 3, 0.5, 1 / 3, 2.0], [1 / 3, 1 / 7, 2 / 3, 2 / 7], [0.0, 0.0, 1 / 3, 1 / 7]]).T
    found = list(zip(*supporting(odd)))
    assert found[0] == found[1] and len(set(found)) == 3


def supporting(ends):
    return [c.tolist() for c in overlaps.supporting_lines(ends)]


def test_nothing_is_written_without_overlaps(features, spark):
    edges = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 0.0), (1, 1.0, 0.0, 2.0, 0.0), (2, 0.5, 0.0, 1.5, 0.0)],
                                  "_group long, ax double, ay double, bx double, by double")
    assert overlaps.partly_overlapping(edges) is None
    assert overlaps.partly_overlapping(edges.limit(0)) is None


def test_edges_on_lines_of_their_own_are_only_counted(spark, monkeypatch):
    """Without two edges on one line nothing but a number per edge is shuffled or written."""
    written = []
    counting = overlaps.stage_counting

    def seen(df, label, **sums):
        written.append((label, df.columns))
        return counting(df, label, **sums)

    monkeypatch.setattr(overlaps, "stage_counting", seen)
    monkeypatch.setattr(overlaps, "stage", lambda df, label: pytest.fail(f"{label} was written"))
    edges = spark.range(200).selectExpr("id % 3 as _group", "0D as ax", "cast(id as double) as ay", "1D as bx", "cast(id * id as double) as by")
    assert overlaps.partly_overlapping(edges) is None
    assert written == [("shared", ["hash"])]
