"""One document of each group of near copies: five-word shingles, Jaccard 0.8 (the pipeline's stage).

Texts of equal shingle sets are taken together first. Operator 4 then finds sets whose SimHash
fingerprints, of five words here, differ in two bits or fewer, by bit planes; these are compared
exactly. Two bits are less than most pairs at 0.8 differ in, so what is still apart is looked for by
keys. Of each set 350 minima under
different hashes are taken, seven to a key: two sets share a minimum with the
probability of their Jaccard similarity, so a pair at 0.8 misses all 50 keys with a
probability of 8 in a million and closer pairs with a smaller one. Sets that share a
key are compared exactly: first all with the smallest of the key, then those of keys that do not hang
together by then. These come by families, which are what keys connect; a family's sets meet in one task,
or in blocks of bounded size, where those are compared that share a key and are not connected
yet, and where only links that connect something are handed on. A key whose sets all hang together
costs its size; a family of unlike sets costs the square in comparisons, but no rows.

Cases: words are cut at 0x20 and 0x09-0x0D and only A-Z change case. Texts with fewer
than five words have one shingle, the whole sequence; null and empty texts and those
without words are copies of each other. Links hold transitively. Columns other than
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.llm import simhash
from fumeline.llm.common import as_text, batch_of, fresh
from fumeline.llm.components import components
from fumeline.session import stage, unstage

SHINGLE = 5
LEAST = 0.8
BANDS, WIDTH = 50, 7
_BLOCK = 1024  # shingles hashed at once
_PAIRS = 1 << 16  # pairs handed on at once
BLOCK_BYTES, BLOCK_SETS = 8 << 20, 2048  # of a family's sets that meet another such block in a task

_rng = np.random.default_rng(42)
_FACTORS = _rng.integers(0, 1 << 31, BANDS * WIDTH, np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, BANDS * WIDTH, np.uint32)[:, None]
_ODD = _rng.integers(0, 1 << 63, (BANDS, WIDTH), np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 1 << 63, BANDS, np.uint64)


def shingles(text: bytes) -> set[bytes]:
    """The distinct runs of five words, their words parted by one space."""
    words = text.lower().split()
    return {b" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def similarity(a: set[bytes], b: set[bytes]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def keys(hashes: np.ndarray) -> np.ndarray:
    """The set's 50 keys, from its shingles' 64-bit hashes."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * WIDTH, ~np.uint32(0))
    for at in range(0, len(high), _BLOCK):
        np.minimum(least, (high[at:at + _BLOCK] * _FACTORS + _SHIFTS).min(1), out=least)
    mixed = (least.reshape(BANDS, WIDTH).astype(np.uint64) * _ODD).sum(1, dtype=np.uint64) + _BAND
    return mixed ^ mixed >> np.uint64(29)


def _marked(batches, names: tuple[str, str, str]):
    for batch in batches:
        marks, held, prints = [], [], []
        for text in batch.column("text"):
            hashes = np.array([xxhash.xxh64_intdigest(s) for s in shingles(text.as_buffer().to_pybytes())], np.uint64)
            hashes.sort()
            marks.append(xxhash.xxh128_digest(hashes.tobytes()))
            held.append(keys(hashes).view(np.int64))
            prints.append(simhash.fingerprint(text.as_buffer().to_pybytes(), SHINGLE))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(marks, pa.binary()), pa.array(held, pa.list_(pa.int64())),
             pa.array(np.array(prints, np.uint64).view(np.int64))],
            names=[*batch.schema.names, *names])


def _stars(batches):
    """Each key's members but the smallest, with the smallest."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        members = batch.column("members")
        sizes = np.diff(members.offsets.to_numpy())
        flat = members.flatten().to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((flat, row))
        flat, heads = flat[order], np.cumsum(sizes) - sizes
        rest = np.ones(len(flat), bool)
        rest[heads] = False
        for at in range(0, len(flat), _PAIRS):
            own = slice(at, at + _PAIRS)
            yield batch_of(out, flat[heads][row[own]][rest[own]], flat[own][rest[own]])


def _compared(batches):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        left, right = batch.column("left"), batch.column("right")
        near, held, own = np.zeros(len(a), bool), None, set()
        for k in range(len(a)):
            if a[k] != held:
                held, own = a[k], shingles(left[k].as_buffer().to_pybytes())
            near[k] = similarity(own, shingles(right[k].as_buffer().to_pybytes())) >= LEAST
        yield batch_of(out, a[near], b[near])


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are similar enough, by the texts (node, text)."""
    # Staged, so that a hot ``a`` comes from several tasks and can be split.
    pairs = stage(pairs.distinct(), "pairs")
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    both = both.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
    near = stage(both.select("a", "b", "left", "right").mapInArrow(_compared, "a long, b long"), "near")
    unstage(pairs)
    return near


def _linked(rows: pa.Table) -> pa.Table:
    """(a, b): links that connect a block's sets, of those that share a key and are not connected by then."""
    names = rows.column("node").to_numpy()
    side = rows.column("side").to_numpy()
    n, whole = len(names), rows.column("p")[0].as_py() == rows.column("q")[0].as_py()
    sets = [np.array(sorted({xxhash.xxh64_intdigest(s) for s in shingles(t.as_buffer().to_pybytes())}), np.uint64)
            for t in rows.column("text")]
    sizes = np.array([len(x) for x in sets])
    ids = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(sizes)[:-1])
    marks = np.zeros(int(max(x.max() for x in ids)) + 1, bool)
    keys = np.stack(rows.column("keys").to_pylist())
    own = np.repeat(np.arange(n), keys.shape[1])
    order = np.argsort(keys.ravel(), kind="stable")
    run = keys.ravel()[order]
    cuts = np.flatnonzero(run[1:] != run[:-1]) + 1
    share = np.zeros((n, n), bool)
    for members in np.split(own[order], cuts):
        if len(members) > 1:
            share[np.ix_(members, members)] = True
    label = np.unique(rows.column("root").to_numpy(), return_inverse=True)[1]
    found = []
    for i in range(n - 1):
        later = share[i, i + 1:] & (label[i + 1:] != label[i])
        if not whole:
            later &= side[i + 1:] != side[i]
        # Sets whose sizes differ by more cannot be similar enough.
        low, high = np.minimum(sizes[i], sizes[i + 1:]), np.maximum(sizes[i], sizes[i + 1:])
        marks[ids[i]] = True
        for j in (np.flatnonzero(later & (low >= LEAST * high)) + i + 1).tolist():
            if label[j] != label[i]:
                both = int(np.count_nonzero(marks[ids[j]]))
                if both / (sizes[i] + sizes[j] - both) >= LEAST:
                    found.append((names[i], names[j]))
                    label[label == label[j]] = label[i]
        marks[ids[i]] = False
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})


def by_fingerprint(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): the similar ones of pairs that operator 4 finds among (node, fp); staged.

    Sets of one fingerprint are compared with the smallest of it, and these along the links of fingerprints.
    """
    prints = stage(nodes.groupBy("fp").agg(F.min("node").alias("low")), "prints")
    same = nodes.join(prints, "fp").filter("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    a, b = (prints.select(F.col("fp").alias(c), F.col("low").alias(f"low_{c}")) for c in "ab")
    close = simhash.linked(prints.select("fp")).join(a, "a").join(b, "b").select(
        F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b"))
    near = compared(same.union(close), texts)
    unstage(prints)
    return near


def links(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links that connect the similar ones of (node, keys, fp), whose texts are among (node, text); staged."""
    first = by_fingerprint(nodes, texts)
    joined = components(first)
    # A few numbers become 50 rows here, so the sets are spread by number, not by size.
    narrow = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "node")
    groups = narrow.select("node", F.explode("keys").alias("key")).groupBy("key").agg(
        F.collect_list("node").alias("members"))
    groups = stage(groups.filter(F.size("members") > 1), "groups")
    # What operator 4 has connected needs no other link.
    stars = groups.select("members").mapInArrow(_stars, "a long, b long").distinct()
    for c in "ab":
        stars = stars.join(joined.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
    stars = stars.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    near = first.union(compared(stars, texts))
    roots = components(near)
    member = groups.filter(F.size("members") > 2).select("key", F.explode("members").alias("node")).join(
        roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    member = stage(member, "rooted")
    # Keys whose sets all hang together are done; what the others hold may still be linked.
    apart = member.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    open_ = stage(member.join(apart.select("key", "low"), "key").select("node", "root", "low").distinct(), "open")
    families = components(open_.select(F.col("low").alias("a"), F.col("root").alias("b")))
    some = open_.select("node", "root").distinct().join(
        families.select(F.col("node").alias("root"), F.col("root").alias("family")), "root", "left").select(
        "node", "root", F.coalesce("family", "root").alias("family")).join(nodes, "node").join(texts, "node")
    more = stage(blocks(some).groupBy("family", "p", "q").applyInArrow(_linked, "a long, b long"), "more")
    every = stage(near.union(more), "every")
    unstage(groups, first, near, joined, roots, member, open_, families, more)
    return every


def blocks(some: DataFrame) -> DataFrame:
    """(family, node, root, keys, text) cut into blocks of bounded size, and each two blocks of a family put together."""
    parts = some.groupBy("family").agg(F.greatest(
        F.ceil(F.sum(F.octet_length("text").cast("long")) / BLOCK_BYTES), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)
    ).cast("int").alias("parts"))
    cut = some.join(parts, "family").withColumn("side", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    return cut.withColumn("x", F.explode(F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1))).select(
        "family", F.least("side", "x").alias("p"), F.greatest("side", "x").alias("q"), "side", "node", "root", "keys", "text")


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component, in its own columns: that of the smallest id, ids before nulls.

    Of several rows with that id in the component one stays.
    """
    mark, held, fp = (fresh(n, docs.columns) for n in ("mark", "keys", "fp"))
    row = fresh("row", docs.columns)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    marked = docs.withColumn("text", as_text()).mapInArrow(
        lambda batches: _marked(batches, (mark, held, fp)), f"{fields}, `{mark}` binary, `{held}` array<long>, `{fp}` long")
    rows = stage(marked.withColumn(row, F.monotonically_increasing_id()), "marked")  # staged: the numbers stay
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.col(row).alias("row"))
    sets = rows.groupBy(mark).agg(F.min(row).alias("node"), F.min(order).alias("kept"))
    sets = stage(sets.select("node", "kept"), "sets")
    nodes = rows.select(F.col(row).alias("node"), F.col(held).alias("keys"), F.col(fp).alias("fp")).join(
        sets.select("node"), "node")
    nodes = stage(nodes, "nodes")
    linked = links(nodes, rows.select(F.col(row).alias("node"), "text"))  # texts only of what is compared
    roots = components(linked)
    kept = stage(sets.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(
        F.min("kept").alias("kept")).select(F.col("kept.row").alias(row)), "kept")
    unstage(nodes, sets, linked, roots)
    return rows.join(kept, row).select(*docs.columns)
