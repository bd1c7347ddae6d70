"""Nearest neighbours through trees, against all products."""

from __future__ import annotations

import numpy as np
import pytest

from fumeline.llm import forest

SCHEMA = "vec_id long, embedding array<float>, label int, uid long, leaves string, score double"


def table(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, "x", 0.5) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def listed(df):
    out: dict = {}
    for r in sorted(df.collect()):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def brute(vectors, every, k):
    """Of usable rows only: (query id, candidates in order)."""
    values = np.array([v for _, v in vectors], np.float32).astype(float)
    ids = [i for i, _ in vectors]
    out = {}
    for row, i in enumerate(ids):
        if i % every == 0:
            scores = (values[row] * values).sum(-1)
            order = sorted((r for r in range(len(ids)) if r != row), key=lambda r: (-scores[r], ids[r]))[:k]
            out[i] = [(n + 1, ids[r], scores[r]) for n, r in enumerate(order)]
    return out


def recall(got, want):
    near = [len({v for _, v, _ in got.get(q, [])} & {v for _, v, _ in own}) / max(1, len(own)) for q, own in want.items()]
    return float(np.mean(near))


@pytest.mark.parametrize("shape", ["free", "clusters", "norms", "shifted"])
def test_recall(spark, shape):
    rng = np.random.default_rng(4)
    values = rng.standard_normal((4000, 24))
    if shape == "clusters":
        values = rng.standard_normal((40, 24))[rng.integers(0, 40, 4000)] + 0.1 * values
    elif shape == "norms":
        values *= rng.lognormal(0, 1, (4000, 1))
    elif shape == "shifted":
        values += 3
    vectors = list(enumerate(values.tolist()))
    got = listed(forest.neighbours(table(spark, vectors), leaf=32))
    want = brute(vectors, 20, 20)
    assert got.keys() == want.keys()
    assert all(len(own) == 20 and [r for r, _, _ in own] == list(range(1, 21)) for own in got.values())
    assert recall(got, want) >= 0.9
    products = {q: {v: s for _, v, s in own} for q, own in brute(vectors, 20, 4000).items()}
    assert all(products[q][v] == s for q, own in got.items() for _, v, s in own)


def test_exact_in_one_leaf(spark):
    """Ties, copies, and fewer candidates than asked for: one leaf holds all, so nothing can be missed."""
    rng = np.random.default_rng(2)
    values = rng.integers(-2, 3, (120, 3)).astype(float)  # many equal vectors and products
    vectors = [(i, v) for i, v in enumerate(values.tolist()) if any(v)]
    assert listed(forest.neighbours(table(spark, vectors))) == brute(vectors, 20, 20)
    few = vectors[:7]
    assert listed(forest.neighbours(table(spark, few), every=2)) == brute(few, 2, 20)


def test_copies(spark):
    """A third of the rows is one vector: every one of them that queries gets its smallest other ids."""
    rng = np.random.default_rng(3)
    vectors = [(i, [1.0, 0, 0] if i % 3 == 0 else rng.uniform(-0.5, 0.5, 3).tolist()) for i in range(900)]
    got = listed(forest.neighbours(table(spark, vectors), leaf=64))
    assert [v for _, v, _ in got[0]] == list(range(3, 63, 3))
    assert [v for _, v, _ in got[60]] == [i for i in range(0, 63, 3) if i != 60][:20]


def test_odd_rows(spark):
    vectors = [(0, [1, 0]), (1, [0.5, 0.5]), (20, [1, 1]), (20, [0, 2]), (None, [1, 1]), (3, None), (4, []), (5, [0, 0]),
               (6, [None, 1]), (7, [float("nan"), 1]), (8, [float("inf"), 1]), (40, [1, 2, 3]), (-20, [-1, 0])]
    got = listed(forest.neighbours(table(spark, vectors)))
    assert got[0] == [(1, 20, 1.0), (2, 1, 0.5), (3, 20, 0.0), (4, -20, -1.0)]
    assert got[-20] == [(1, 20, 0.0), (2, 1, -0.5), (3, 0, -1.0), (4, 20, -1.0)]
    # Each of the two rows of id 20 queries, and finds the other.
    assert sorted(v for _, v, _ in got[20]) == sorted([-20, 0, 1, 20] * 2)
    assert 40 not in got


def test_nothing_to_find(spark):
    assert forest.neighbours(table(spark, [])).count() == 0
    assert forest.neighbours(table(spark, [(20, [1, 2])])).count() == 0
    assert forest.neighbours(table(spark, [(1, [1, 2]), (3, [2, 1])])).count() == 0
    assert forest.neighbours(table(spark, [(20, [0, 0]), (40, None)])).count() == 0


def test_units_in_parts(spark, monkeypatch):
    """Blocks and chunks of a unit change nothing."""
    rng = np.random.default_rng(6)
    vectors = list(enumerate(rng.standard_normal((1500, 8)).tolist()))
    whole = listed(forest.neighbours(table(spark, vectors), every=4, leaf=64))
    monkeypatch.setattr(forest, "BLOCK", 50 * 8 * 8)
    monkeypatch.setattr(forest, "CHUNK", 20)
    assert listed(forest.neighbours(table(spark, vectors), every=4, leaf=64)) == whole


def test_search_order():
    """The queue yields every leaf of every tree once, and nearer cells first."""
    rng = np.random.default_rng(1)
    values = rng.standard_normal((2000, 10))
    own = forest.Forest(values, float(np.linalg.norm(values, axis=1).max()), 6, 3)
    shadows = own.shadows(values[:1])[0]
    seen = list(own.nearest(shadows))
    assert sorted(seen) == [(t, leaf) for t in range(3) for leaf in range(64)]

    def away(tree, leaf):
        total = 0.0
        for level in range(6):
            node, bit = leaf >> (6 - level), leaf >> (5 - level) & 1
            over = shadows[tree][level] - own.splits[tree][level][node]
            total += over * over if (over >= 0) != bool(bit) else 0.0
        return total

    far = [away(*x) for x in seen]
    assert far == pytest.approx(sorted(far))
    leaves = own.leaves(values)
    assert all(np.bincount(leaves[:, t], minlength=64).min() > 10 for t in range(3))
