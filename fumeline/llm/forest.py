"""Nearest neighbours by inner product through a forest of random-projection trees (operator 12).

Every tree has random directions, orthonormal as far as there are dimensions, one per
level; a node splits what it holds at the median of its projections. For inner products
all vectors get one more coordinate that makes them equally long, which turns the largest
product into the smallest distance. A query searches all trees through one priority queue:
the next node is the one whose cell is nearest, by the squares of the projections' way
over the splits passed on the wrong side. The vectors of the leaves it visits are compared
by their own inner products in double precision, and the best stay.

Trees are fitted on a sample picked by a hash (``SAMPLE`` vectors, 64 MB at most); all
vectors are put into all trees. Below the sample's reach a node takes the median of the
nearest node above that has enough of it. Leaves hold some ``LEAF`` vectors up to
``2 ** DEPTH`` leaves a tree, whose split points and sizes tasks hold, and more beyond. How
many leaves a query visits is measured, not set: a sample of queries is compared with all
vectors, and the queue goes on until ``RECALL`` of their true neighbours were met. Vectors
without any structure thus cost a search of most leaves; none is missed by a limit that
was meant for others.

Equal vectors are searched once, and their rows listed afterwards, the smallest ids first.
A unit is a subtree of some leaves; its vectors and queries meet in blocks of bounded size,
vectors first, so a task holds one block and streams the queries past it. The best of a block
alone go on.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor
do those of another length than most (of equally frequent lengths, than the shortest), or rows without
an id. Rows of one id are rows of their own: each is a candidate for the others, and each
queries if its id is divisible. Equal products rank by id. With fewer candidates than ``k`` all
are returned; a lone vector has none. An empty table gives no rows. Columns other than ``vec_id``
and ``embedding`` are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fumeline.llm.common import batch_of
from fumeline.session import stage, stage_counting, unstage

TREES = 4
LEAF = 256
DEPTH = 18
SAMPLE = 16_384
SAMPLE_BYTES = 64 << 20
TUNED = 128  # queries whose recall sets the number of leaves
RECALL = 0.95
UNIT = 4  # levels of a unit's subtree, or more, so that a query comes to a few units a tree
BLOCK, CHUNK = 32 << 20, 8192  # bytes of vectors held and queries streamed by a unit's part
_CELLS = 1 << 21  # products taken at once
_LEAST = 8  # sampled vectors that give a node its own median
_SPARE = 4  # kept beyond those asked for until products are taken exactly


class Forest:
    """Directions and split points of all trees.

    ``splits[t][level][node]`` is a node's split point; a node's children are ``2 * node``
    below the point and ``2 * node + 1`` above.
    """

    def __init__(self, sample: np.ndarray, top: float, depth: int, trees: int, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.top, self.depth, self.trees = top, depth, trees
        wide = sample.shape[1] + 1
        self.ways, self.splits = [], []
        lifted = self.lifted(sample)
        for _ in range(trees):
            turns = [np.linalg.qr(rng.standard_normal((wide, wide)))[0] for _ in range(-(-max(depth, 1) // wide))]
            way = np.concatenate(turns, 1)[:, :depth]
            self.ways.append(way)
            self.splits.append(self._fitted(lifted @ way))

    def _fitted(self, shadow: np.ndarray) -> list[np.ndarray]:
        node, splits = np.zeros(len(shadow), np.int64), []
        for level in range(self.depth):
            point = np.full(1 << level, np.nan)
            for up in range(level + 1):  # own vectors first, else those of a node above
                of, missing = node >> up, np.isnan(point)
                if not missing.any():
                    break
                order = np.lexsort((shadow[:, level], of))
                cuts = np.searchsorted(of[order], np.arange((1 << (level - up)) + 1))
                held = np.diff(cuts)
                middle = np.full(len(held), np.nan)
                enough = held >= (_LEAST if up < level else 1)
                middle[enough] = shadow[order[(cuts[:-1] + held // 2)[enough]], level]
                point[missing] = middle[np.arange(1 << level) >> up][missing]
            splits.append(np.nan_to_num(point))
            node = node * 2 + (shadow[:, level] >= splits[-1][node])
        return splits

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.top ** 2 - (vectors ** 2).sum(1), 0))
        return np.concatenate([vectors, rest[:, None]], 1)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        lifted, out = self.lifted(vectors), []
        for way, splits in zip(self.ways, self.splits):
            shadow, node = lifted @ way, np.zeros(len(vectors), np.int64)
            for level in range(self.depth):
                node = node * 2 + (shadow[:, level] >= splits[level][node])
            out.append(node)
        return np.stack(out, 1)

    def shadows(self, queries: np.ndarray) -> list[list[list[float]]]:
        """Per query and tree its projections; a query is made as long as the vectors, with nothing in the added coordinate."""
        queries = queries * (self.top / np.sqrt((queries ** 2).sum(1, keepdims=True)))
        return np.stack([queries @ way[:-1] for way in self.ways], 1).tolist()

    def nearest(self, shadows: list[list[float]]) -> Iterator[tuple[int, int]]:
        """(tree, leaf) of all trees, the nearest cell first."""
        queue = [(0.0, t, 0, 0) for t in range(self.trees)]
        while queue:
            far, tree, level, node = heapq.heappop(queue)
            shadow, splits = shadows[tree], self.splits[tree]
            while level < self.depth:
                over = shadow[level] - splits[level].item(node)
                near = 2 * node + (over >= 0)
                level += 1
                heapq.heappush(queue, (far + over * over, tree, level, near ^ 1))
                node = near
            yield tree, node

    def visited(self, shadows: list[list[float]], most: int, sizes: list[np.ndarray], least: int) -> list[tuple[int, int]]:
        """The first ``most`` leaves, and further ones until one tree's hold ``least`` vectors."""
        out, held = [], [0] * self.trees
        for tree, leaf in self.nearest(shadows):
            out.append((tree, leaf))
            held[tree] += int(sizes[tree][leaf])
            if len(out) >= most and max(held) >= least:
                break
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _rated(batches, forest: Forest):
    for batch in batches:
        leaves = forest.leaves(_matrix(batch.column("vector")))
        at = np.arange(0, leaves.size + 1, forest.trees, dtype=np.int32)
        held = pa.ListArray.from_arrays(pa.array(at), pa.array(leaves.ravel().astype(np.int32)))
        yield pa.RecordBatch.from_arrays([*batch.columns, held], names=[*batch.schema.names, "leaves"])


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed the same way wherever they are taken."""
    return (queries * vectors).sum(-1)


def _best(queries: np.ndarray, vectors: np.ndarray, uids: np.ndarray, out: np.ndarray | None, k: int):
    """(query, place, product): the best ``k`` vectors of each query; ``out`` marks pairs to compare."""
    rough = queries @ vectors.T
    if out is not None:
        rough[~out] = -np.inf
    most = min(k + _SPARE, rough.shape[1])
    place = np.argpartition(-rough, most - 1, 1)[:, :most]
    query = np.repeat(np.arange(len(queries)), most)
    place = place.ravel()
    real = np.isfinite(rough[query, place])
    query, place = query[real], place[real]
    exact = products(queries[query], vectors[place])
    order = np.lexsort((uids[place], -exact, query))
    query, place, exact = query[order], place[order], exact[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < k], place[rank < k], exact[rank < k]


_TRUE = pa.schema([("query", pa.int32()), ("uid", pa.int64()), ("score", pa.float64()), ("leaves", pa.list_(pa.int32()))])


def _true(batches, queries: np.ndarray, own: np.ndarray, k: int):
    """The best of each batch for the queries that are measured."""
    for batch in batches:
        if batch.num_rows:
            uids = batch.column("uid").to_numpy()
            other = own[:, None] != uids[None]
            query, place, exact = _best(queries, _matrix(batch.column("vector")), uids, other, k)
            yield batch_of(_TRUE, query, uids[place], exact, batch.column("leaves").take(pa.array(place)))


def _probes(batches, forest: Forest, most: int, sizes: list[np.ndarray], least: int, unit: int, schema: pa.Schema):
    """A row per query and unit with the unit's leaves that the query visits."""
    for batch in batches:
        rows, trees, units, lists = [], [], [], []
        for row, shadows in enumerate(forest.shadows(_matrix(batch.column("vector")))):
            held: dict[tuple[int, int], list[int]] = {}
            for tree, leaf in forest.visited(shadows, most, sizes, least):
                held.setdefault((tree, leaf >> unit), []).append(leaf)
            rows += [row] * len(held)
            trees += [t for t, _ in held]
            units += [u for _, u in held]
            lists += held.values()
        vectors = batch.column("vector").take(pa.array(rows, pa.int64()))
        yield batch_of(schema, trees, units, batch.column("uid").to_numpy()[rows], vectors, lists)


_FOUND = pa.schema([("query", pa.int64()), ("uid", pa.int64()), ("score", pa.float64())])


def _compared(batches, k: int):
    """The best vectors of each part of a unit; a part's vectors come before its queries."""
    key, uids, vectors, leaves = None, [], [], []
    held = None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("tree", "unit", "block", "chunk", "asks"))))
        at = 0
        while at < len(keys):
            to = at
            while to < len(keys) and keys[to] == keys[at]:
                to += 1
            own, part = keys[at], batch.slice(at, to - at)
            at = to
            if own[:4] != key:
                key, uids, vectors, leaves, held = own[:4], [], [], [], None
            if not own[4]:
                uids.append(part.column("uid").to_numpy())
                vectors.append(_matrix(part.column("vector")))
                leaves.append(part.column("leaves").flatten().to_numpy())
                continue
            if not uids:
                continue
            if held is None:
                name, place = np.unique(np.concatenate(leaves), return_inverse=True)
                held = np.concatenate(uids), np.concatenate(vectors), name, place
            step = max(1, _CELLS // len(held[0]))
            for low in range(0, part.num_rows, step):
                asked = part.slice(low, step)
                lists = asked.column("leaves")
                flat = lists.flatten().to_numpy()
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                spot = np.minimum(np.searchsorted(held[2], flat), len(held[2]) - 1)
                known = held[2][spot] == flat
                visits = np.zeros((len(lists), len(held[2])), bool)
                visits[row[known], spot[known]] = True
                some = np.flatnonzero(visits.any(0)[held[3]])  # what the leaves hold that any of these visits
                if len(some):
                    query, place, exact = _best(
                        _matrix(asked.column("vector")), held[1][some], held[0][some], visits[:, held[3][some]], k)
                    yield batch_of(_FOUND, asked.column("uid").to_numpy()[query], held[0][some][place], exact)


def _usable(table: DataFrame) -> DataFrame:
    """(row, vec_id, vector, k1, k2): the rows that take part; the ks stand for the vector."""
    vector = F.col("embedding")
    number = F.monotonically_increasing_id()
    rows = table.select(number.alias("row"), F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(
            F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vector", lambda x: x != 0), F.lit(False)))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "d").first()
    if common is None:
        return rows.withColumns({"k1": F.lit(0), "k2": F.lit(0)}).limit(0)
    kept = rows.filter(F.size("vector") == common["d"])
    return kept.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(1), "vector")})


def _up_to(df: DataFrame, k: int, of: str, *order) -> DataFrame:
    """The first ``k`` rows of each ``of``; tasks drop all but ``k`` before the shuffle."""
    place = F.row_number().over(Window.partitionBy(of).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= k)


def neighbours(table: DataFrame, every: int = 20, k: int = 20, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row whose id is divisible by ``every``."""
    spark = table.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    rows = stage(_usable(table), "usable")
    # Equal vectors go by their first row.
    classes = stage(rows.groupBy("k1", "k2").agg(F.min("row").alias("uid")), "classes")
    members = stage(rows.select("row", "vec_id", "k1", "k2").join(classes, ["k1", "k2"]).select(
        "uid", "vec_id", "row"), "members")
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    unique, seen = stage_counting(
        rows.join(classes.select("uid"), F.col("row") == F.col("uid")).select("uid", "vector"), "unique",
        n=F.count(F.lit(1)), top=F.sqrt(F.max(norm)), d=F.max(F.size("vector")))
    unstage(rows, classes)
    n, dimensions = seen["n"], seen["d"]
    if not n:
        return spark.createDataFrame([], empty)

    def sampled(df: DataFrame, most: int, of: int):
        """About ``most`` of ``of`` rows, by a hash."""
        return df.filter(F.pmod(F.xxhash64(F.lit(7), "uid"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, most / of)))

    asking = members.filter(F.col("vec_id") % every == 0).select("uid").distinct()
    queries, asked = stage_counting(unique.join(asking, "uid"), "queries", n=F.count(F.lit(1)))
    if not asked["n"]:
        return spark.createDataFrame([], empty)
    depth = min(DEPTH, max(0, math.ceil(math.log2(n / leaf))))
    most = min(SAMPLE, SAMPLE_BYTES // (8 * dimensions))
    sample = _matrix(sampled(unique, most, n).select("vector").toArrow().column(0).combine_chunks())
    if not len(sample):
        sample = _matrix(unique.select("vector").limit(most).toArrow().column(0).combine_chunks())
    forest = Forest(sample, seen["top"], depth, trees)
    kind = unique.schema["vector"].dataType.simpleString()
    arrow = pa.list_(pa.float32() if kind == "array<float>" else pa.float64())
    if kind not in ("array<float>", "array<double>"):
        unique, queries = (df.withColumn("vector", F.col("vector").cast("array<double>")) for df in (unique, queries))
        kind = "array<double>"
    placed = stage(unique.mapInArrow(
        lambda b: _rated(b, forest), f"uid long, vector {kind}, leaves array<int>"), "placed")
    # One count per leaf, of which there are at most 2^DEPTH a tree.
    sizes = [np.zeros(1 << depth, np.int64) for _ in range(trees)]
    counted = placed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").agg(
        F.count(F.lit(1)).alias("n")).toArrow()
    for tree, own, held in zip(*(c.to_numpy() for c in counted.columns)):
        sizes[tree][own] = held
    probes = _tuned(placed, sampled(queries, TUNED, asked["n"]), queries, forest, k)
    levels = min(depth, max(UNIT, math.ceil(math.log2(probes / trees))))
    schema = pa.schema([("tree", pa.int32()), ("unit", pa.int32()), ("uid", pa.int64()), ("vector", arrow),
                        ("leaves", pa.list_(pa.int32()))])
    asks = stage(queries.mapInArrow(
        lambda b: _probes(b, forest, probes, sizes, k + 1, levels, schema),
        f"tree int, unit int, uid long, vector {kind}, leaves array<int>"), "asks")
    found = _met(placed, asks, levels, max(1, BLOCK // (8 * dimensions)), k + 1)
    # The same pair may come from several trees, with the same product.
    best = _up_to(found.groupBy("query", "uid").agg(F.max("score").alias("score")), k + 1, "query", F.desc("score"), "uid")
    ids = _up_to(members, k + 1, "uid", "vec_id", "row").select("uid", "vec_id", "row")
    listed = _up_to(best.select("query", "uid", "score").join(ids, "uid"), k + 1, "query", F.desc("score"), "vec_id", "row")
    tops = listed.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("_place", "vec_id", "row", "score"))).alias("top"))
    tops = stage(tops, "tops")
    asking = members.filter(F.col("vec_id") % every == 0).select(F.col("uid").alias("query"), "vec_id", "row")
    own = F.slice(F.filter("top", lambda x: x["row"] != F.col("row")), 1, k)
    return asking.join(tops, "query").select(
        F.col("vec_id").alias("query_id"), F.posexplode(own).alias("_at", "_of")).select(
        "query_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_of.vec_id").alias("vec_id"),
        F.col("_of.score").alias("score"))


def _tuned(placed: DataFrame, some: DataFrame, queries: DataFrame, forest: Forest, k: int) -> int:
    """How many leaves meet ``RECALL`` of the true neighbours of some queries."""
    chosen = some.toArrow()
    if not chosen.num_rows:
        chosen = queries.limit(TUNED).toArrow()
    vectors, own = _matrix(chosen.column("vector").combine_chunks()), chosen.column("uid").to_numpy()
    best = placed.mapInArrow(lambda b: _true(b, vectors, own, k), "query int, uid long, score double, leaves array<int>")
    true = _up_to(best, k, "query", F.desc("score"), "uid").select("query", "leaves").toArrow()
    wanted: dict[int, list] = {}
    for query, leaves in zip(true.column("query").to_pylist(), true.column("leaves").to_pylist()):
        wanted.setdefault(query, []).append(leaves)
    places = []
    for query, shadows in enumerate(forest.shadows(vectors)):
        open_ = wanted.get(query, [])
        for place, (tree, leaf) in enumerate(forest.nearest(shadows)):
            met = sum(leaves[tree] == leaf for leaves in open_)
            if met:
                places += [place] * met
                open_ = [leaves for leaves in open_ if leaves[tree] != leaf]
            if not open_:
                break
    return 1 + sorted(places)[math.ceil(RECALL * len(places)) - 1] if places else 1


def _met(placed: DataFrame, asks: DataFrame, levels: int, block: int, k: int) -> DataFrame:
    """(query, uid, score): the best of each part of a unit for each of its queries."""
    unit = F.shiftright("leaf", levels)
    vectors = placed.select("uid", "vector", F.posexplode("leaves").alias("tree", "leaf")).select(
        "tree", unit.alias("unit"), "uid", "vector", F.array("leaf").alias("leaves"))
    held = vectors.groupBy("tree", "unit").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    asked = asks.groupBy("tree", "unit").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    sizes = stage(held.join(asked, ["tree", "unit"]), "units")
    spread = F.xxhash64(F.lit(3), "uid")

    def each(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    columns = ["tree", "unit", "block", "chunk", "asks", "uid", "vector", "leaves"]
    stay = vectors.join(sizes, ["tree", "unit"]).withColumns(
        {"block": F.pmod(spread, "blocks").cast("int"), "asks": F.lit(False)}).withColumn("chunk", each("chunks"))
    come = asks.join(sizes, ["tree", "unit"]).withColumns(
        {"chunk": F.pmod(spread, "chunks").cast("int"), "asks": F.lit(True)}).withColumn("block", each("blocks"))
    part = ["tree", "unit", "block", "chunk"]
    both = stay.select(columns).union(come.select(columns)).repartition(
        int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), *part)
    return both.sortWithinPartitions(*part, "asks").mapInArrow(
        lambda b: _compared(b, k), "query long, uid long, score double")
