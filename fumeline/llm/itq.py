"""Embedding near-duplicates by iterative quantisation (operator 2).

A rotation of the principal axes is learned on a bounded sample so that the signs of a
rotated vector are a balanced binary code of up to 64 bits. Codes are retrieved through
a table per 16 bits of code: two codes are compared if they differ in at most two bits
of one of these stretches, found by meeting under a key that is one bit or none away
from either. So every pair within 11 of 64 bits is compared, and most that are farther.
Pairs within ``RADIUS`` bits are reranked by the cosine of the original vectors in
double precision, in blocks of the vectors that hold the two codes.

Links are told by the uncentred cosine, so the codes are tried on pairs at the least cosine
made from the sample, and less of the mean is taken off, or the radius widened, until
most of them are compared. Vectors of a strong common direction then have many
candidates.

Identical vectors are one node and equal codes one entry of the tables, so hot vectors
cost one row; long lists under a key, and codes of many vectors, are cut into blocks
that meet pairwise, each small.

Cases: vectors that are null, zero, or hold null or non-finite components link with
nothing and are kept. Vectors of different length never link. Rows that repeat a
``vec_id`` are one vector, the least of them (nulls last). A null ``vec_id`` is a vector
of its own id, null, and links with nothing. An empty table gives an empty result. Columns
other than ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.llm.common import batch_of
from fumeline.llm.components import components
from fumeline.session import stage

LEAST_COSINE = 0.9
RADIUS = 18  # bits of 64 in which the codes of a link differ at most, or some more where that misses links
RECALL = 0.93  # share of pairs at the least cosine that must be compared
SAMPLE_ROWS = 20_000  # vectors that the rotation is learned on, at most
KEY_BITS = 16
LIST = 4096  # codes under a key that are compared in one block
BLOCK = 256  # vectors of a code that are compared in one block
_PAIRS = 1 << 20


def learn(sample: np.ndarray, rounds: int = 50, seed: int = 2, centred: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, axes): codes are the signs of (unit vector - mean) @ axes; of the mean a share is taken off."""
    size = sample.shape[1]
    bits = min(64, size)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else sample
    mean = centred * unit.mean(0) if len(sample) else np.zeros(size)
    spread = (unit - mean).T @ (unit - mean)
    axes = np.linalg.eigh(spread)[1][:, ::-1][:, :bits]
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    flat = (unit - mean) @ axes
    for _ in range(rounds if len(sample) else 0):
        left, _, right = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
        turn = right.T @ left.T
    return mean, axes @ turn


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _codes(batches, mean: np.ndarray, axes: np.ndarray):
    out = pa.schema([("node", pa.int64()), ("code", pa.int64())])
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _matrix(batch.column("embedding"))
        unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
        yield batch_of(out, batch.column("node"), _signs(unit, mean, axes).view(np.int64))


def _part(codes: np.ndarray, table: int) -> np.ndarray:
    return codes >> np.uint64(KEY_BITS * table) & np.uint64((1 << KEY_BITS) - 1)


def meeting(x: np.ndarray, y: np.ndarray, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """The (table, key) under which a pair of codes is counted: the first table in which they
    differ in at most two bits, and the least key next to both; table -1 if there is none."""
    table, key = np.full(len(x), -1, np.int64), np.zeros(len(x), np.uint64)
    for t in range(tables - 1, -1, -1):
        a, b = _part(x, t), _part(y, t)
        differ = a ^ b
        far = np.bitwise_count(differ)
        low = differ & (np.uint64(0) - differ)
        middle = np.where(far == 2, np.minimum(a ^ low, b ^ low), np.minimum(a, b))
        table, key = np.where(far <= 2, t, table), np.where(far <= 2, middle, key)
    return table, key


def _near(batches, tables: int, radius: int):
    """Pairs of codes under each key, each pair under one key only."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        lists = batch.column("members")
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        struct = lists.flatten()
        codes = struct.field("code").to_numpy().view(np.uint64)
        side = struct.field("side").to_numpy()
        owner = np.repeat(np.arange(len(sizes)), sizes)
        after = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes)) - 1  # members behind this one
        table, key = batch.column("table").to_numpy(), batch.column("key").to_numpy()
        whole = batch.column("one").to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(after), 0
        while at < len(codes):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
            n = after[at:to]
            i = np.repeat(np.arange(at, to), n)
            j = i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            near = np.bitwise_count(codes[i] ^ codes[j]) <= radius
            near &= whole[owner[i]] | (side[i] != side[j])
            i, j = i[near], j[near]
            t, k = meeting(codes[i], codes[j], tables)
            own = (t == table[owner[i]]) & (k == key[owner[i]].astype(np.uint64))
            x, y = codes[i[own]].view(np.int64), codes[j[own]].view(np.int64)
            yield batch_of(out, np.minimum(x, y), np.maximum(x, y))
            at = to


def _signs(unit: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    signs = np.zeros((len(unit), 64), bool)
    signs[:, :axes.shape[1]] = (unit - mean) @ axes >= 0
    return np.packbits(signs, axis=1, bitorder="little").view("<u8")[:, 0]


def partners(sample: np.ndarray, least: float, most: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors at the least cosine of a link: sampled ones, turned towards another of the sample."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    rng = np.random.default_rng(3)
    a, b = unit[rng.integers(0, len(unit), most)], unit[rng.integers(0, len(unit), most)]
    away = b - (a * b).sum(1, keepdims=True) * a
    length = np.linalg.norm(away, axis=1, keepdims=True)
    apart = length[:, 0] > 1e-6
    a, away = a[apart], away[apart] / length[apart]
    return a, least * a + np.sqrt(max(0.0, 1 - least * least)) * away


def fitted(sample: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, axes, radius): the first of growing reach by which enough pairs at the least cosine are compared.

    Centring widens the angle of a pair if all vectors share a direction; less of the mean
    is taken off then, and more pairs are candidates. If nothing holds, the best is taken.
    """
    best, chosen = -1.0, None
    for centred in (1.0, 0.75, 0.5, 0.25, 0.0):
        mean, axes = learn(sample, centred=centred)
        a, b = partners(sample, least) if len(sample) else (sample, sample)
        if not len(a):
            return mean, axes, RADIUS
        x, y = _signs(a, mean, axes), _signs(b, mean, axes)
        met = meeting(x, y, -(-axes.shape[1] // KEY_BITS))[0] >= 0
        for radius in (RADIUS, RADIUS + 4, RADIUS + 8):
            recall = float((met & (np.bitwise_count(x ^ y) <= radius)).mean())
            if recall > best:
                best, chosen = recall, (mean, axes, radius)
            if recall >= RECALL:
                return chosen
    return chosen


def code_pairs(codes: DataFrame, tables: int, radius: int = RADIUS, longest: int = LIST) -> DataFrame:
    """(a, b), a < b: distinct codes to be reranked."""
    width = 1 << KEY_BITS
    keys = []
    for t in range(tables):
        own = F.shiftrightunsigned("code", KEY_BITS * t).bitwiseAND(F.lit(width - 1))
        keys += [F.struct(F.lit(t).alias("table"), own.bitwiseXOR(F.lit(flip)).cast("int").alias("key"))
                 for flip in [0, *(1 << b for b in range(KEY_BITS))]]
    # A code becomes a row per key here, so the codes are spread by number, not by size.
    spread = codes.repartition(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "code")
    keyed = spread.select("code", F.inline(F.array(*keys)))
    long = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > longest)
    cut = F.coalesce(F.ceil(F.col("held") / F.lit(longest)).cast("int"), F.lit(1))
    split = keyed.join(long, ["table", "key"], "left").withColumn("cut", cut).withColumn(
        "side", F.pmod(F.xxhash64("code"), F.col("cut")).cast("int"))
    # A code of part s meets those of every part x under (min, max) of the two.
    met = split.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("cut") - 1))).select(
        "table", "key", F.least("side", "x").alias("p"), F.greatest("side", "x").alias("q"), "side", "code")
    lists = met.groupBy("table", "key", "p", "q").agg(F.collect_list(F.struct("side", "code")).alias("members"))
    return lists.filter(F.size("members") > 1).select(
        "table", "key", (F.col("p") == F.col("q")).alias("one"), "members",
    ).mapInArrow(lambda b: _near(b, tables, radius), "a long, b long")


def _linked(batches, least: float):
    """Blocks of vectors against blocks: how many vectors each links with, and its root in the block."""
    out = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    for batch in batches:
        same = batch.column("same").to_numpy(zero_copy_only=False)
        for k in range(batch.num_rows):
            ids, counts, units = [], [], []
            for name in ("left", "right"):
                members = batch.column(name)[k].values
                rows = _matrix(members.field("embedding"))
                ids.append(members.field("node").to_numpy())
                counts.append(members.field("n").to_numpy())
                units.append(rows / np.linalg.norm(rows, axis=1, keepdims=True))
            link = units[0] @ units[1].T >= least
            if same[k]:
                np.fill_diagonal(link, False)
            a, b = np.nonzero(link)
            if not len(a):
                continue
            # Roots: the least node that hangs together with each within this block.
            root = [ids[0].copy(), ids[1].copy()]
            while True:
                low = np.minimum(root[0][a], root[1][b])
                before = [r.copy() for r in root]
                np.minimum.at(root[0], a, low)
                np.minimum.at(root[1], b, low)
                if same[k]:
                    root[0] = root[1] = np.minimum(*root)
                if all((r == s).all() for r, s in zip(root, before)):
                    break
            yield batch_of(out, ids[0], link @ counts[1], root[0])
            if not same[k]:
                yield batch_of(out, ids[1], link.T @ counts[0], root[1])


def _links(nodes: DataFrame, size: int, least: float, sample_rows: int) -> DataFrame:
    """(node, links, root) from blocks, for vectors of one length."""
    own = nodes.filter(F.size("embedding") == size)
    sample = own.orderBy(F.xxhash64("node"), "node").limit(sample_rows).select("embedding").collect()
    mean, axes, radius = fitted(np.array([r[0] for r in sample], np.float64).reshape(-1, size), least)
    coded = own.join(own.select("node", "embedding").mapInArrow(
        lambda b: _codes(b, mean, axes), "node long, code long"), "node")
    coded = stage(coded.select("code", "node", "n", "embedding"), "coded")
    distinct = coded.groupBy("code").agg(F.count(F.lit(1)).alias("held"))
    pairs = code_pairs(distinct.select("code"), -(-min(64, size) // KEY_BITS), radius)
    several = distinct.filter(F.col("held") > 1).select(F.col("code").alias("a"), F.col("code").alias("b"))
    parts = F.ceil(F.col("held") / F.lit(BLOCK)).cast("long")
    blocks = stage(coded.join(distinct, "code").withColumn("part", F.pmod(F.xxhash64("node"), parts)).repartition(
            "code", "part").groupBy("code", "part").agg(F.collect_list(F.struct("node", "n", "embedding")).alias("members")), "blocks")
    left = blocks.select(F.col("code").alias("a"), F.col("part").alias("p"), F.col("members").alias("left"))
    right = blocks.select(F.col("code").alias("b"), F.col("part").alias("q"), F.col("members").alias("right"))
    met = pairs.unionByName(several).join(left, "a").join(right, "b").filter(
        (F.col("a") != F.col("b")) | (F.col("p") <= F.col("q")))
    same = (F.col("a") == F.col("b")) & (F.col("p") == F.col("q"))
    return met.select(same.alias("same"), "left", "right").mapInArrow(
        lambda b: _linked(b, least), "node long, links long, root long")


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector."""
    given = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    known = given.filter(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    sound = finite & F.exists("embedding", lambda x: x != 0)
    known = stage(known.withColumn("embedding", F.when(F.coalesce(sound, F.lit(False)), F.col("embedding"))), "vectors")
    usable = known.filter(F.col("embedding").isNotNull())
    nodes = stage(usable.groupBy("embedding").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n")), "nodes")
    sizes = sorted(r[0] for r in nodes.select(F.size("embedding")).distinct().collect())
    spark = vectors.sparkSession
    found = spark.createDataFrame([], "node long, links long, root long")
    for size in sizes:
        found = found.unionByName(_links(nodes, size, least, sample_rows))
    found = stage(found, "links")
    roots = components(found, "node", "root").withColumnRenamed("root", "component")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    about = nodes.join(links, "node", "left").join(roots, "node", "left").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"))
    told = usable.join(about, "embedding").select("vec_id", "n_links", "component_id")
    alone = known.filter(F.col("embedding").isNull()).select("vec_id").unionByName(
        given.filter(F.col("vec_id").isNull()).select("vec_id"))
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return told.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
