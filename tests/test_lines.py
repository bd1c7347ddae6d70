from __future__ import annotations

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fumeline.operators import lines
from fumeline.operators.clustering import snap
from fumeline.operators.lines import chain_vertices, chains, distinct_edges, single_part
from fumeline.session import stage
from tests import brute


def chain_sets(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r["g"]].append((r["ring"], tuple((p["x"], p["y"]) for p in r["path"])))
    for g, got in found.items():
        assert len(got) == len(set(got))
    return {g: set(got) for g, got in found.items()}


def expected(rows):
    by_group = defaultdict(list)
    for g, paths in rows:
        by_group[g] += [[(float(x), float(y)) for x, y in p] for p in paths]
    found = {g: brute.chains_of(paths) for g, paths in by_group.items()}
    return {g: c for g, c in found.items() if c}


SHAPES = {
    "two pieces": [[(0, 0), (1, 0)], [(1, 0), (2, 1)]],
    "junction": [[(0, 0), (1, 0)], [(1, 0), (2, 1)], [(1, 0), (2, -1)]],
    "junction inside a path": [[(0, 0), (1, 0), (2, 0)], [(1, 0), (1, 5)]],
    "triangle": [[(0, 0), (1, 0)], [(1, 0), (1, 1)], [(1, 1), (0, 0)]],
    "closed path": [[(2, 2), (1, 0), (1, 1), (2, 2)]],
    "two closed paths": [[(0, 0), (1, 0), (1, 1), (0, 0)], [(5, 5), (6, 5), (6, 6), (5, 5)]],
    "same edge reversed": [[(0, 0), (1, 0)], [(1, 0), (0, 0)]],
    "overlap": [[(0, 0), (1, 0), (2, 0), (3, 0)], [(4, 0), (3, 0), (2, 0)]],
    "lollipop": [[(0, 0), (1, 0)], [(1, 0), (2, 0), (2, 1), (1, 0)]],
    "figure of eight": [[(0, 0), (1, 1), (1, -1), (0, 0)], [(0, 0), (-1, 1), (-1, -1), (0, 0)]],
    "stops and returns": [[(0, 0), (1, 0), (1, 0), (2, 0), (1, 0)]],
    "no length": [[(3, 3), (3, 3)], [(3, 3)]],
    "ring of reversed pieces": [[(0, 0), (1, 0)], [(1, 1), (1, 0)], [(1, 1), (0, 1)], [(0, 0), (0, 1)]],
    "gap between paths": [[(0, 0), (1, 0)], [(2, 0), (3, 0)]],
}


def test_shapes(features):
    one_each = [(name, [path]) for name, paths in SHAPES.items() for path in paths]
    multipart = [(f"{name}, one feature", paths) for name, paths in SHAPES.items()]
    rows = one_each + multipart
    assert chain_sets(chains(features(rows), ["g"])) == expected(rows)


def vertex_sets(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r["g"], r["chain"], r["ring"]].append((r["place"], (r["x"], r["y"])))
    out = defaultdict(set)
    for (g, _, ring), places in found.items():
        places.sort()
        assert [n for n, _ in places] == list(range(len(places)))
        out[g].add((ring, brute.settled([p for _, p in places], ring)))
    return dict(out)


def test_shapes_as_vertices(features):
    rows = list(SHAPES.items()) + [(f"{n}, apart", [p]) for n, ps in SHAPES.items() for p in ps]
    assert vertex_sets(chain_vertices(features(rows), ["g"])) == expected(rows)


def test_named_shapes(features):
    got = chain_sets(chains(features(list((n, p) for n, p in SHAPES.items())), ["g"]))
    assert got["two pieces"] == {(False, ((0, 0), (1, 0), (2, 1)))}
    assert len(got["junction"]) == 3
    assert got["triangle"] == {(True, ((0, 0), (1, 0), (1, 1), (0, 0)))}
    assert got["same edge reversed"] == {(False, ((0, 0), (1, 0)))}
    assert "no length" not in got


def test_distinct_edges_keeps_coincident_pieces_once(features):
    rows = distinct_edges(features([("a", SHAPES["overlap"]), ("b", SHAPES["overlap"])]), ["g"])
    got = sorted((r["g"], r["ax"], r["bx"]) for r in rows.collect())
    assert got == [(g, i, i + 1) for g in "ab" for i in range(4)]


def test_snap_joins_ends_that_nearly_meet(features):
    near = features([("a", [[(0, 0), (1, 0)]]), ("a", [[(1.004, 0.003), (2, 0)]])])
    assert chains(near, ["g"]).count() == 2
    joined = chains(snap(near, 0.01), ["g"]).collect()
    assert [[(p["x"], p["y"]) for p in r["path"]] for r in joined] == [[(0, 0), (1, 0), (2, 0)]]


def test_no_features(features):
    assert chains(features([]), ["g"]).count() == 0
    assert chains(features([("a", [])]), ["g"]).count() == 0


def test_single_part_repeats_group_attributes(features, spark):
    df = features([("a", SHAPES["junction"]), ("b", SHAPES["two pieces"])])
    groups = spark.createDataFrame([("a", 1), ("b", 2)], "g string, n int")
    got = single_part(df, groups, ["g"]).groupBy("g", "n").count().collect()
    assert sorted(map(tuple, got)) == [("a", 1, 3), ("b", 2, 1)]


def test_hot_group_is_split_when_it_gets_its_number(spark):
    """Nearly all lines have one key; adaptive execution spreads them in the join."""
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    df = spark.range(40_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("g"),
        F.col("id").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("line"),
    ).repartition(8)
    before = {n: spark.conf.get(n, None) for n in settings_}
    for name, value in settings_.items():
        spark.conf.set(name, value)
    try:
        groups = lines.number_groups(df.groupBy("g").agg(F.avg("n").alias("mean")))
        joined = lines.with_group(df, groups, ["g"])
        assert len(joined.collect()) == 40_000
        text = joined._jdf.queryExecution().executedPlan().toString()
        named = lines._keyed(stage(joined.select("_group", "line"), "joined"), groups)
        assert len(named.collect()) == 40_000 and named.columns == ["g", "mean", "line"]
        back = named._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert "SortMergeJoin(skew=true)" in text and "SortMergeJoin(skew=true)" in back


point = st.tuples(st.integers(0, 4), st.integers(0, 3))
path = st.lists(point, min_size=1, max_size=6)
feature = st.tuples(st.sampled_from("abc"), st.lists(path, max_size=3))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(feature, min_size=1, max_size=12), min_size=12, max_size=12))
def test_any_lines(features, batches):
    # Many small cases per Spark run, each in groups of its own.
    rows = [(f"{i}{g}", paths) for i, batch in enumerate(batches) for g, paths in batch]
    want = expected(rows)
    shuffled = random.Random(len(rows)).sample(rows, len(rows))
    got = chain_sets(chains(features(shuffled).repartition(3), ["g"]))
    assert got == want
    edges = {g: brute.edges_of([[(float(x), float(y)) for x, y in p] for gg, ps in rows if gg == g
                                for p in ps]) for g in want}
    for g, found in got.items():
        # No length is lost, and open chains end where other than two edges meet.
        total = sum(brute.length(line) for _, line in found)
        assert total == pytest.approx(sum(brute.length(e) for e in edges[g]))
        ends = defaultdict(int)
        for e in edges[g]:
            for n in e:
                ends[n] += 1
        open_ends = sum(d for d in ends.values() if d != 2)
        assert sum(not ring for ring, _ in found) * 2 == open_ends


def test_one_group_holds_nearly_all_rows(features):
    """One key with one long line, one long ring and a hub where 300 lines meet."""
    n = 700
    line = [("hot", [[(i, 0), (i + 1, 0)]]) for i in range(n)]
    ring = [("hot", [[(i, 9), ((i + 1) % n, 9 if i + 1 < n else 9)]]) for i in range(n)]
    hub = [("hot", [[(-5, -5), (-6 - i, -9)]]) for i in range(300)]
    rows = line + ring + hub + [("cold", [[(0, 0), (1, 1)]])]
    random.Random(3).shuffle(rows)
    df = features(rows).repartition(4)
    assert chain_sets(chains(df, ["g"])) == expected(rows) == vertex_sets(chain_vertices(df, ["g"]))


def test_rounds_grow_with_the_logarithm(features, monkeypatch):
    rounds = []
    kept = lines.stage_counting
    monkeypatch.setattr(
        lines, "stage_counting",
        lambda df, label, **sums: rounds.append(label) or kept(df, label, **sums),
    )
    chains(features([("a", [[(i, 0), (i + 1, 0)]]) for i in range(1000)]), ["g"])
    assert rounds.count("round") <= 6
    rounds.clear()
    # Edges that follow one another on a path need no rounds at all.
    chains(features([("a", [[(i, 0) for i in range(1000)]])]), ["g"])
    assert rounds.count("round") == 0


def test_one_long_line_among_many_short_ones(features):
    long = [(k, k * k) for k in range(4000)]
    rows = [("a", [[(k, -1), (k, -2)]]) for k in range(300)] + [("a", [long[:2500]]), ("a", [long[2499:]])]
    df = features(rows).repartition(5)
    assert chain_sets(chains(df, ["g"])) == expected(rows)
    numbers = lines._stage_features(df, lines.number_groups(df.select("g").distinct()), ["g"], "paths")
    got = sorted((r["feature"], len(r["line"])) for r in numbers.collect())
    assert all(a + n <= b for (a, n), (b, _) in zip(got, got[1:]))  # no number is used twice
    assert got[-1][0] < 302 * 2501  # a long line widens its own partition's numbers only


def test_input_order_and_partitions_do_not_matter(features):
    rows = [("a", [[(i % 7, i % 5), ((i * 3) % 7, (i * 2) % 5)]]) for i in range(40)]
    one = chain_sets(chains(features(rows).coalesce(1), ["g"]))
    many = chain_sets(chains(features(rows[::-1]).repartition(7, F.rand(1)), ["g"]))
    assert one == many == expected(rows)


def test_chains_through_many_slices(spark, features, monkeypatch):
    """Chains and rings that are cut into slices of a few pieces come out as those in one slice."""
    rng = random.Random(5)
    long = [[(i, i % 7), (i + 1, (i + 1) % 7)][:: rng.choice((1, -1))] for i in range(60)]
    ring = [[(i, 100 + i * i), ((i + 1) % 31, 100 + ((i + 1) % 31) ** 2)] for i in range(31)]
    rows = [("a", [p]) for p in long] + [("a", [p]) for p in ring] + [("b", [p]) for p in ring[:-1]]
    rows += [("c", [p]) for p in SHAPES["ring of reversed pieces"] + SHAPES["lollipop"]]
    rng.shuffle(rows)
    monkeypatch.setattr(lines, "_SLICE_PIECES", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert chain_sets(chains(features(rows), ["g"])) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_zero_has_one_sign(features):
    rows = [("a", [[(-0.0, -0.0), (1, 0)]]), ("b", [[(1, -0.0), (2, 3)], [(-0.0, 5), (1, 0.0)]])]
    for made in (chains(features(rows), ["g"]).selectExpr("inline(path)"), chain_vertices(features(rows), ["g"])):
        found = [v for r in made.select("x", "y").collect() for v in r]
        assert len(found) == 10 and not any(str(v) == "-0.0" for v in found)
