"""A prefix trie of conversations as a z-fast trie (operator 11).

A conversation is a string whose letters are its turns. A depth of it is named by the
128-bit hash of the turns up to there; a running XOR of hashes of (place, turn) gives all
of them. The compacted trie is a table with a row per node: where it ends (a branching, or the
end of a conversation), its parent, and its handle, which is the prefix at the two-fattest
number between the parent's depth and its own. A conversation's exit is found by fat binary
search: handles at two-fattest depths are looked up, a found one moves the lower bound to the end of its
node, a missing one the upper bound below it, so a conversation of n turns takes log2(n)
look-ups. Conversations go in by batches, each some eight times the last. Those of a batch
that leave the trie together meet in an aggregate by prefix, together with the edges they
leave through, which are cut where they part; all other edges stay as they are.

Equal conversations are one string, so a conversation that a third of them repeats is one
row. A prefix that many share is an aggregate with partial results, and a look-up key in a
join whose other side has one row per key and that is split like any hot key. Sums over
subtrees move up by doubled pointers: log2 of the trie's height rounds, each an aggregate.
What all conversations below a node save is told from the words on their ways, so nothing
is summed path by path. Nodes inside an edge differ from its end in what they save and in their
children only; they are made last, from the edge.

A conversation's turns meet in one task, as hashes of 24 bytes; texts are not carried on. The ids that
end at a node are hashed as a stream, from sorted bundles of ids, so their number is not bounded by memory.

Cases: turns rank by ``turn`` (null first), equal ones by role, then text; null roles and
texts are empty. Rows without ``conv_id`` belong to no conversation. A conversation
without turns ends at the root. An empty table has no node. Repeated rows are turns of their
own. Columns other than ``conv_id``, ``turn``, ``role`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fumeline.llm.common import WORD, batch_of, mix
from fumeline.session import stage, stage_counting, unstage

PARTS = (1, 8, 64)  # of 64 parts of the conversations, how many are in after each batch
LOOKUPS = 3  # before what is still searched is written down
BUNDLE = 1 << 16  # ids hashed at once

_NAME = ["depth", "e1", "e2"]


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the largest power of two divides."""
    apart = low.bitwiseXOR(high).cast("long")
    below = F.length(F.bin(apart)) - 1  # the highest bit in which the bounds differ
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), below)).cast("int")


def _at(array: str, depth: Column) -> Column:
    """The hash of a prefix, from an array that starts at depth 1; zero for the empty one."""
    return F.when(depth < 1, F.lit(0).cast("long")).otherwise(F.get(array, depth - 1))


_MARKED = pa.schema([("conv_id", pa.int64()), ("n", pa.int32()), ("p1", pa.list_(pa.int64())),
                     ("p2", pa.list_(pa.int64())), ("words", pa.list_(pa.int64()))])
_MARKED_DDL = "conv_id long, n int, p1 array<long>, p2 array<long>, words array<long>"


def _marked(batches):
    """Prefix hashes and running sums of words from turns' hashes and words."""
    for batch in batches:
        columns = [batch.column(c) for c in ("v1", "v2", "words")]
        sizes = np.diff(columns[0].offsets.to_numpy()).astype(np.int64)
        ends = np.cumsum(sizes)
        starts = np.repeat(ends - sizes, sizes)
        place = (np.arange(len(starts)) - starts + 1).astype(np.uint64)
        made = []
        for k, column in enumerate(columns[:2]):
            own = column.flatten().to_numpy().view(np.uint64)
            step = mix(own + mix(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)))
            run = np.append(np.uint64(0), np.bitwise_xor.accumulate(step)) if len(step) else np.zeros(1, np.uint64)
            made.append((run[1:] ^ run[starts]).view(np.int64))
        total = np.append(0, np.cumsum(columns[2].flatten().to_numpy()))
        made.append(total[1:] - total[starts])
        offsets = pa.array(np.append(0, ends).astype(np.int32))
        yield batch_of(_MARKED, batch.column("conv_id"), sizes.astype(np.int32),
                       *[pa.ListArray.from_arrays(offsets, pa.array(m, pa.int64())) for m in made])


def rebuilt(table: DataFrame, group: int = 20, shared: int = 4) -> DataFrame:
    """(conv_id, n, p1, p2, words): each conversation with the first turns of its group's first one.

    A conversation c takes crc32(c) % ``shared`` turns of conversation c - c % ``group``
    in the place of as many of its own.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turns = table.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    ).select("conv_id", F.row_number().over(order).alias("at"), F.xxhash64(F.lit(1), "role", "text").alias("v1"),
             F.xxhash64(F.lit(2), "role", "text").alias("v2"), "words")
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "v1", "v2", "words"))).alias("own"))
    own = stage(own, "turns")
    heads = own.select(F.col("conv_id").alias("base"), F.slice("own", 1, shared - 1).alias("head"))
    kept = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared)).cast("int")
    both = own.select("conv_id", "own", kept.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    taken = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("own", F.lit(1), F.lit(0)))
    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
    every = both.join(heads, "base", "left").select("conv_id", F.concat(taken, rest).alias("all"))
    arrays = every.select("conv_id", *[F.col("all")[c].alias(c) for c in ("v1", "v2", "words")])
    return arrays.mapInArrow(_marked, _MARKED_DDL)


def _located(paths: DataFrame, trie: DataFrame, longest: int) -> DataFrame:
    """The paths with ``a``, the depth of the deepest node that is a prefix of them, by fat binary search."""
    handles = trie.select(F.col("f").alias("_f"), F.col("f1").alias("_f1"), F.col("f2").alias("_f2"),
                          F.col("depth").alias("_depth"), F.col("e1").alias("_e1"), F.col("e2").alias("_e2"),
                          F.col("up").alias("_up"))
    names = paths.columns
    open_ = paths.withColumns({"a": F.lit(0), "b": F.col("n")})
    rounds, done = longest.bit_length() + 1, []
    while rounds > 0:
        for _ in range(min(LOOKUPS, rounds)):
            looks = F.col("a") < F.col("b")
            f = fattest(F.col("a"), F.col("b"))
            asked = open_.withColumn("_at", F.when(looks, f)).withColumns(
                {"_k1": F.when(looks, _at("p1", F.col("_at"))), "_k2": F.when(looks, _at("p2", F.col("_at")))})
            met = asked.join(handles, (F.col("_at") == F.col("_f")) & (F.col("_k1") == F.col("_f1"))
                             & (F.col("_k2") == F.col("_f2")), "left")
            found = F.col("_f").isNotNull()
            whole = found & (F.col("_depth") <= F.col("n")) & (_at("p1", F.col("_depth")) == F.col("_e1")) & (
                _at("p2", F.col("_depth")) == F.col("_e2"))
            # A node whose handle is a prefix, but not its end, is where the path leaves.
            a = F.when(whole, F.col("_depth")).when(found, F.col("_up")).otherwise(F.col("a"))
            b = F.when(whole, F.greatest("b", "_depth")).when(found, F.col("_up")).when(
                looks, F.col("_at") - 1).otherwise(F.col("b"))
            open_ = met.select(*names, a.alias("a"), b.alias("b"))
        rounds -= LOOKUPS
        if rounds > 0:
            step, seen = stage_counting(open_, "searched", left=F.count_if(F.col("a") < F.col("b")))
            if not seen["left"]:
                return _together([*done, step]).drop("b")
            done.append(step.filter("a >= b"))
            open_ = step.filter("a < b")
    return _together([*done, open_]).drop("b")


def _together(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def _prefixes(paths: DataFrame, low: str, high: str) -> DataFrame:
    """A row per depth in (low, high] of a path, with the hashes before, there and after."""
    d = F.col("d")
    after = [F.when(d < F.col(high), F.get(p, d)).alias(n) for p, n in (("p1", "n1"), ("p2", "n2"))]
    steps = F.when(F.col(low) < F.col(high), F.sequence(F.col(low) + 1, F.col(high)))
    return paths.withColumn("d", F.explode(steps)).select(
        d.alias("depth"), _at("p1", d).alias("e1"), _at("p2", d).alias("e2"), _at("p1", d - 1).alias("q1"),
        _at("p2", d - 1).alias("q2"), *after, (d == F.col(high)).alias("stops"), F.col("conv_id").alias("path"))


_TRIE = ["depth", "e1", "e2", "up", "u1", "u2", "s1", "s2", "f", "f1", "f2", "path"]


def _inserted(trie: DataFrame | None, batch: DataFrame, paths: DataFrame, longest: int) -> DataFrame:
    """The trie with a batch of new paths; an edge that some of them leave through is made anew."""
    if trie is None:
        rows = _prefixes(batch.withColumn("a", F.lit(0)), "a", "n")
        left = None
    else:
        found = stage(_located(batch, trie, longest), "located")
        new = _prefixes(found, "a", "n")
        a = F.col("a")
        exits = found.filter(a < F.col("n")).select(
            a.alias("up"), _at("p1", a + 1).alias("s1"), _at("p2", a + 1).alias("s2")).distinct()
        touched = stage(trie.join(exits, ["up", "s1", "s2"]).select(*_TRIE), "touched")
        edges = touched.select("path", "up", "depth").join(
            paths.withColumnRenamed("conv_id", "path"), "path").withColumnRenamed("path", "conv_id")
        rows = new.unionByName(_prefixes(edges, "up", "depth"))
        left = trie.join(touched.select(*_NAME), _NAME, "left_anti")
    parts = (F.min("n1") != F.max("n1")) | (F.min("n2") != F.max("n2"))
    steps = rows.groupBy(*_NAME).agg(
        F.min("path").alias("path"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
        (F.max("stops") | F.coalesce(parts, F.lit(False))).alias("ends"))
    # Depths that follow one another under one path make edges; each goes up to the next end.
    in_path = Window.partitionBy("path").orderBy("depth")
    steps = steps.repartition("path").withColumn("run", F.col("depth") - F.row_number().over(in_path))
    onward = Window.partitionBy("path", "run").orderBy("depth").rowsBetween(0, Window.unboundedFollowing)
    to = F.first(F.when(F.col("ends"), F.col("depth")), ignorenulls=True).over(onward)
    of_edge = Window.partitionBy("path", "run", "to")
    edge = steps.withColumn("to", to).withColumn("up", F.min("depth").over(of_edge) - 1)
    edge = edge.withColumn("f", fattest(F.col("up"), F.col("to")))

    def there(value: str, depth: Column) -> Column:
        return F.max(F.when(F.col("depth") == depth, F.col(value)))

    first, to, f = F.col("up") + 1, F.col("to"), F.col("f")
    made = edge.groupBy("path", "run", "to", "up", "f").agg(
        there("e1", to).alias("e1"), there("e2", to).alias("e2"), there("q1", first).alias("u1"),
        there("q2", first).alias("u2"), there("e1", first).alias("s1"), there("e2", first).alias("s2"),
        there("e1", f).alias("f1"), there("e2", f).alias("f2")).withColumnRenamed("to", "depth").select(*_TRIE)
    return stage(made if left is None else left.select(*_TRIE).unionByName(made), "trie")


def compacted(paths: DataFrame) -> DataFrame:
    """The z-fast trie of (conv_id, n, p1, p2): a row per node, the root left out."""
    longest = paths.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    part = F.pmod(F.xxhash64("conv_id"), F.lit(PARTS[-1]))
    trie, low = None, 0
    narrow = paths.select("conv_id", "n", "p1", "p2")
    for high in PARTS:
        after = _inserted(trie, narrow.filter((part >= low) & (part < high)), narrow, longest)
        if trie is not None:
            unstage(trie)
        trie, low = after, high
    return trie


_SUMS = ["members", "first", "leaves", "ways", "edges"]


def _below(nodes: DataFrame) -> DataFrame:
    """(id, and sums over the node and all nodes below it), pointers going twice as far in each round."""
    def total(columns):
        return [F.min("first").alias("first") if c == "first" else F.sum(c).alias(c) for c in columns]

    state, seen = stage_counting(nodes.select("id", F.col("parent").alias("ptr"), *_SUMS), "sums",
                                 left=F.count("ptr"))
    while seen["left"]:
        up = state.filter("ptr is not null").groupBy(F.col("ptr").alias("id")).agg(
            *[c.alias(f"_{n}") for c, n in zip(total(_SUMS), _SUMS)])
        far = state.filter("ptr is not null").select(F.col("id").alias("ptr"), F.col("ptr").alias("far"))
        moved = state.join(up, "id", "left").select(
            "id", "ptr", *[(F.least("first", "_first") if c == "first" else F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c)
                           for c in _SUMS])
        # A node that is its own root's child points nowhere.
        ended = moved.filter("ptr is null").select("id", F.lit(None).cast("long").alias("ptr"), *_SUMS)
        going = moved.filter("ptr is not null").join(far, "ptr", "left").select("id", F.col("far").alias("ptr"), *_SUMS)
        after, seen = stage_counting(ended.unionByName(going), "sums", left=F.count("ptr"))
        unstage(state)
        state = after
    return state.drop("ptr")


_BUNDLE = pa.schema([("n", pa.int32()), ("e1", pa.int64()), ("e2", pa.int64()), ("first", pa.int64()), ("ids", pa.binary())])


def _bundled(batches):
    """Runs of a node's ids, which come sorted, as text."""
    for batch in batches:
        names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("n", "e1", "e2")], 1)
        ids = batch.column("conv_id").to_numpy()
        cuts = np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1
        runs = [x for a, b in zip([0, *cuts], [*cuts, len(ids)]) for x in range(a, b, BUNDLE)] if len(ids) else []
        ends = [*runs[1:], len(ids)]
        yield batch_of(_BUNDLE, names[runs, 0].astype(np.int32), names[runs, 1], names[runs, 2], ids[runs],
                       [",".join(map(str, ids[a:b].tolist())).encode() for a, b in zip(runs, ends)])


_DIGEST = pa.schema([("depth", pa.int32()), ("e1", pa.int64()), ("e2", pa.int64()), ("digest", pa.string())])


def _digested(batches):
    """The hash of each node's ids from its bundles, which come sorted."""
    name, state = None, None
    for batch in batches:
        done = []
        for own, ids in zip(zip(*(batch.column(c).to_pylist() for c in ("n", "e1", "e2"))), batch.column("ids")):
            if own != name:
                if name is not None:
                    done.append((*name, state.hexdigest()))
                name, state = own, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
        if done:
            yield batch_of(_DIGEST, *map(list, zip(*done)))
    if name is not None:
        yield batch_of(_DIGEST, *[[x] for x in (*name, state.hexdigest())])


def _digests(ended: DataFrame) -> DataFrame:
    """(depth, e1, e2, digest) of (n, e1, e2, conv_id)."""
    name = ["n", "e1", "e2"]
    bundles = ended.repartitionByRange("e1", "e2", "n", "conv_id").sortWithinPartitions("e1", "e2", "n", "conv_id").mapInArrow(
        _bundled, "n int, e1 long, e2 long, first long, ids binary")
    return bundles.repartition(*name).sortWithinPartitions(*name, "first").mapInArrow(
        _digested, "depth int, e1 long, e2 long, digest string")


NOTHING = hashlib.sha256(b"").hexdigest()


def nodes(table: DataFrame) -> DataFrame:
    """The uncompacted trie's nodes with their members, children, leaves, savings and ends."""
    n = F.col("n")
    convs = stage(rebuilt(table), "rebuilt").withColumns({"e1": _at("p1", n), "e2": _at("p2", n)})
    ends = stage(convs.groupBy("n", "e1", "e2").agg(
        F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("members")), "ends")
    paths = stage(convs.join(ends.select(F.col("first").alias("conv_id")), "conv_id").select(
        "conv_id", "n", "p1", "p2", "words"), "paths")
    trie = compacted(paths)
    digests = stage(_digests(convs.select("n", "e1", "e2", "conv_id")), "digests")

    # Nodes with numbers, their parents' numbers, and what they add to all nodes above.
    numbered = stage(trie.withColumn("id", F.monotonically_increasing_id()), "numbered")
    above = numbered.select(F.col("depth").alias("up"), F.col("e1").alias("u1"), F.col("e2").alias("u2"),
                            F.col("id").alias("parent"))
    deep = numbered.filter("up > 0").join(above, ["up", "u1", "u2"])
    linked = deep.unionByName(numbered.filter("up = 0").withColumn("parent", F.lit(None).cast("long")))
    words = paths.select(F.col("conv_id").alias("path"), "words")
    long = linked.join(words, "path").select(
        "id", "parent", "path", "up", *_NAME, F.slice("words", F.col("up") + 1, F.col("depth") - F.col("up")).alias("words"),
        _at("words", F.col("up")).alias("before"))
    held = ends.select(n.alias("depth"), "e1", "e2", F.col("first").alias("_first"), F.col("members").alias("_members"))
    own = stage(long.join(held, _NAME, "left").join(digests, _NAME, "left"), "nodes")
    children = stage(own.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("children")), "children")
    whole = stage(own.join(children, "id", "left").withColumns({
        "children": F.coalesce("children", F.lit(0)), "members": F.coalesce("_members", F.lit(0)),
        "first": F.col("_first"), "way": F.element_at("words", -1)}).withColumns({
            "leaves": (F.col("children") == 0).cast("long"), "ways": F.col("members") * F.col("way"),
            "edges": F.col("way") - F.col("before")}).drop("_first", "_members"), "whole")
    sums = stage(_below(whole), "below")
    unstage(own, children, numbered)

    top = ends.agg(F.min("first").alias("first"), F.sum("members").alias("members")).first()
    if top["first"] is None:
        return _named(ends.sparkSession.createDataFrame([], _OUT))
    total = whole.agg(F.count_if(F.col("parent").isNull()).alias("children"), F.sum("leaves").alias("leaves"),
                      (F.sum("ways") - F.sum("edges")).alias("saved")).first()
    digest = digests.filter("depth = 0").select("digest").first()
    root = whole.sparkSession.createDataFrame([(
        top["first"], 0, None, top["members"], total["children"], total["leaves"] or 1, total["saved"] or 0,
        digest["digest"] if digest else NOTHING)], _OUT)

    of = whole.select("id", "parent", "up", "depth", "children", "digest", "words", "before", "way", F.col("edges").alias("edge"))
    full = of.join(sums, "id")
    parents = sums.select(F.col("id").alias("parent"), F.col("first").alias("parent_first"))
    placed = full.filter("parent is not null").join(parents, "parent").unionByName(
        full.filter("parent is null").withColumn("parent_first", F.lit(top["first"])))
    # What the nodes below the edge's end save, then what the edge's own rest adds.
    below = F.col("ways") - F.col("members") * F.col("way") - (F.col("edges") - F.col("edge"))
    at, last = F.col("_at"), F.col("_at") == F.size("words") - 1
    before = F.when(at == 0, F.col("before")).otherwise(F.get("words", at - 1))
    inner = placed.withColumn("_below", below).withColumn(
        "_at", F.explode(F.sequence(F.lit(0), F.size("words") - 1))).select(
        F.col("first").alias("conv_id"), (F.col("up") + 1 + at).cast("long").alias("depth"),
        F.when(at == 0, F.col("parent_first")).otherwise(F.col("first")).alias("parent_conv_id"),
        F.col("members").alias("n_convs"), F.when(last, F.col("children")).otherwise(F.lit(1)).alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("_below") + (F.col("members") - 1) * (F.col("way") - before)).alias("saved_tokens"),
        F.when(last, F.coalesce("digest", F.lit(NOTHING))).otherwise(F.lit(NOTHING)).alias("ends_sha256"))
    return _named(root.unionByName(inner))


_OUT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")


def _named(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in (c.split() for c in _OUT.split(", "))])
