"""The conversations' trie against a plain one."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fumeline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, n int, path string, words long, h int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in rows], SCHEMA).repartition(3)


def plain(rows):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node."""
    held: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            held.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    for own in held.values():
        own.sort()
    whole = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(x[1:] for x in held.get(base, [])[:h] + own[h:])
    nodes: dict = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children: dict = {}
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)

    def below(key):
        leaves, saved = 0, 0
        stack = [key]
        while stack:
            at = stack.pop()
            leaves += at not in children
            if at:
                saved += (len(nodes[at]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", at[-1][1]))
            stack += children.get(at, [])
        return leaves, saved

    out = []
    for key, members in nodes.items():
        ends = sorted(c for c in members if len(whole[c]) == len(key))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members),
                    len(children.get(key, [])), *below(key), digest))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(seed, n=300, longest=9, letters=3):
    rng = random.Random(seed)
    words = ["a", "b c", "d e f", "", None]
    rows = []
    for c in rng.sample(range(-40, 5 * n), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", None]) if t % 2 else "user", words[rng.randrange(letters)]))
    return rows


@pytest.mark.parametrize("seed, longest, letters", [(1, 9, 3), (2, 4, 5), (3, 40, 2)])
def test_against_plain(spark, seed, longest, letters):
    rows = made(seed, 300, longest, letters)
    assert got(trie.nodes(table(spark, rows))) == plain(rows)


def test_odd_rows(spark):
    rows = [(0, None, "user", "first"), (0, 1, "user", "one"), (0, 1, "user", "one"), (0, 1, "assistant", "tied"),
            (None, 0, "user", "nobody"), (7, 0, None, None), (7, -3, "user", "  kept as word"), (21, 5, "user", "no base"),
            (-21, 1, "user", "minus"), (3, 0, "user", "x " * 100_000), (40, 2, "user", "a\tb\x0bc")]
    assert got(trie.nodes(table(spark, rows))) == plain(rows)


def test_hot_conversation(spark):
    """A third of all conversations are equal, another third share their first turns."""
    rows = []
    for c in range(0, 6000):
        kind = c % 3
        rows += [(c, 0, "user", "hello there"), (c, 1, "assistant", "yes" if kind < 2 else str(c % 50)),
                 (c, 2, "user", "same end" if kind < 1 else str(c % 700))]
    assert got(trie.nodes(table(spark, rows))) == plain(rows)


def test_long_ones(spark):
    """Prefixes of one long conversation, and some that leave it."""
    rows = []
    for k in range(60):
        n = 3 * k + 1
        rows += [(k, t, "user", f"turn {t}" if k % 4 or t < n - 1 else f"own {k}") for t in range(n)]
    assert got(trie.nodes(table(spark, rows))) == plain(rows)


def test_empty(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        found = trie.nodes(table(spark, rows))
        assert found.count() == 0 and found.columns[0] == "conv_id"


def test_only_root(spark):
    """A conversation whose own turns are all replaced, without a base, has none."""
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 1)
    rows = [(c, 0, "user", "gone")]
    assert got(trie.nodes(table(spark, rows))) == plain(rows)
    assert len(plain(rows)) == 1


def test_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    rows = spark.createDataFrame(pairs, "a int, b int").select("a", "b", trie.fattest(F.col("a"), F.col("b"))).collect()
    assert all(f == max(range(a + 1, b + 1), key=lambda x: x & -x) for a, b, f in rows)


def test_search_finds_nodes(spark):
    """Fat binary search leads every path to itself, and a new one to the last node on its way."""
    rows = made(5, 200, 8, 3)
    convs = trie.rebuilt(table(spark, rows)).cache()
    paths = convs.filter("n > 0").dropDuplicates(["n", "p1", "p2"])
    made_trie = trie.compacted(paths)
    longest = paths.agg(F.max("n")).first()[0]
    found = trie._located(paths, made_trie, longest)
    assert found.filter("a <> n").count() == 0
    cut = paths.filter("n > 1").select("conv_id", (F.col("n") - 1).alias("n"), "p1", "p2")
    ends = {(r["depth"], r["e1"], r["e2"]) for r in made_trie.collect()}
    for r in trie._located(cut, made_trie, longest).collect():
        on_way = [d for d in range(1, r["n"] + 1) if (d, r["p1"][d - 1], r["p2"][d - 1]) in ends]
        assert r["a"] == max(on_way, default=0)
