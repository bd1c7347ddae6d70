"""Vertices that nearly meet, and components."""

from __future__ import annotations

import math
import random

import pytest

from fumeline.operators.clustering import meeting, snap
from fumeline.operators.components import components
from fumeline.operators.lines import chains


def moves(spark, points, tolerance):
    df = spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double").repartition(3)
    return {(r["x"], r["y"]): (r["to_x"], r["to_y"]) for r in meeting(df, tolerance).collect()}


def test_ends_meet_wherever_cells_end(spark, features):
    """Pairs 0.02 apart, at every place against the cells' borders, and each pair by itself."""
    points, pairs = [], []
    for k in range(120):
        x, y, turn = 10 * k + k * 0.0137, 7 * k + k * 0.0093, k * 0.7
        pair = [(x, y), (x + 0.02 * math.cos(turn), y + 0.02 * math.sin(turn))]
        pairs.append(pair)
        points += pair
    got = moves(spark, points, 1.0)
    for a, b in pairs:
        assert got.get(a, a) == got.get(b, b) == min(a, b)
    rows = [("g%d" % k, [[(a[0] - 3, a[1] - 2), a], [b, (b[0] + 3, b[1] + 1)]]) for k, (a, b) in enumerate(pairs[:40])]
    joined = chains(snap(features(rows), 1.0), ["g"]).collect()
    assert len(joined) == 40 and all(len(r["path"]) == 3 for r in joined)


def test_no_line_longer_than_the_tolerance_vanishes(spark, features):
    """A dense line keeps its ends apart; lines of half a unit may go, longer ones may not."""
    dense = [(0.3 * k, 0.0) for k in range(60)]
    short, long = [(100.0, 100.0), (100.49, 100.0)], [(200.0, 200.0), (201.01, 200.0)]
    rows = [("dense", [dense]), ("short", [short]), ("long", [long])]
    got = {r["g"]: r["path"] for r in chains(snap(features(rows), 1.0), ["g"]).collect()}
    assert got["dense"][0]["x"] == 0.0 and got["dense"][-1]["x"] == pytest.approx(17.7)
    assert len(got["long"]) == 2 and "short" not in got


@pytest.mark.parametrize("seed", range(2))
def test_random_points(spark, seed):
    rng = random.Random(seed)
    points = list({(round(rng.uniform(0, 40), 3), round(rng.uniform(0, 40), 3)) for _ in range(500)})
    got = moves(spark, points, 1.0)
    at: dict = {}
    for p in points:
        at.setdefault(got.get(p, p), []).append(p)
    for to, own in at.items():
        assert to == min(own)
        assert math.dist((min(x for x, _ in own), min(y for _, y in own)), (max(x for x, _ in own), max(y for _, y in own))) <= 1.0
    # Two that have nothing else within twice the tolerance meet if they are near.
    for i, a in enumerate(points):
        near = [b for b in points if b != a and math.dist(a, b) <= 2]
        if len(near) == 1 and math.dist(a, near[0]) < 0.85 and all(math.dist(near[0], c) > 2 for c in points if c not in (a, near[0])):
            assert got.get(a, a) == got.get(near[0], near[0])


def test_many_in_one_place(spark):
    """Thousands of vertices within a cell are linked by one link each."""
    rng = random.Random(3)
    points = {(5 + rng.uniform(0, 0.3), 5 + rng.uniform(0, 0.3)) for _ in range(4000)} | {(9.0, 9.0)}
    got = moves(spark, points, 1.0)
    low = min(p for p in points if p != (9.0, 9.0))
    assert len(got) == 3999 and set(got.values()) == {low}


def test_snap_keeps_rows(spark, features):
    rows = [("a", [[(0, 0), (1, 0)], []]), ("a", []), ("b", [[(1.001, 0), (2, 0)]])]
    df = features(rows).unionByName(spark.createDataFrame([("c", None)], features(rows).schema))
    got = {(r["g"], str(r["paths"])) for r in snap(df, 0.1).collect()}
    assert len(got) == 4 and any(g == "b" and "x=1.0, " in p for g, p in got)
    with pytest.raises(ValueError):
        snap(df, 0.0)


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(rng.randrange(3000, 3300), rng.randrange(3000, 3300)) for _ in range(150)]
    links += [(5, 5), (7, 6)]
    root = {n: n for p in links for n in p}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {n: got.get(n, n) for n in root} == {n: find(n) for n in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
