"""Mixing sources to target weights (operator 3).

Each source's documents, in an order by a hash of their id, are one run of words that is
packed into blocks of fixed length. Sources share all words by weight, up to three times
their own; what a source cannot take is shared anew. A source's target is a number of
slots. Slots are dealt to output shards by multinomial draws that are conditional on the
sources' totals (each shard draws from what is left), so the mix meets its targets
instead of scattering about them. Slot k of a source is block perm(k mod blocks) in the
pass k div blocks over its blocks, a new pseudorandom permutation per pass; slots and
blocks are joined by that index.

Cases: a null or empty text has no words and takes part in nothing; it returns with
``taken`` 0. A null source is a source of its own, the last one. Documents with a null
id are ordered by size. Repeated rows are documents of their own. An empty table gives
an empty result. No document is taken more than three times, because no source is.
Columns other than ``doc_id``, ``text`` and ``source`` are carried only if asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fumeline.llm.common import SPACES, as_text, batch_of, delimiters, slices, text_bytes, word_bounds
from fumeline.session import stage

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
MOST = 3  # a source gives at most so many times its words
BLOCK_WORDS = 64
SHARD_SLOTS = 1 << 16
BUCKET_ROWS = 2000  # documents whose offsets are summed up in one task


def _sizes(batches, keep_text: bool):
    inside = delimiters(*SPACES)
    for batch in batches:
        for part in slices(batch):
            _, _, first = word_bounds(*text_bytes(part.column("text")), inside)
            names = [n for n in part.schema.names if keep_text or n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(n) for n in names], pa.array(np.diff(first), pa.int64())], names=[*names, "size"])


def sizes(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """(doc_id, source, size), and the text if asked for."""
    read = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string").alias("source"), as_text())
    text = ", text string" if keep_text else ""
    return read.mapInArrow(lambda b: _sizes(b, keep_text), f"doc_id long, source string{text}, size long")


def targets(sized: DataFrame, block_words: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS,
            most: int = MOST) -> DataFrame:
    """One row per source: no, source, source_size, target, blocks, slots.

    A source gets the smaller of its limit and level * weight, the level being such that
    all is shared out. In the order of limit / weight the limited sources come first, so
    the level follows from running sums. The windows run over one row per source.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    no = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("no", F.lit(len(weights))) + 1)
    rows = by_source.withColumn("no", no).withColumn("weight", weight).withColumn(
        "bound", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("bound") / F.col("weight"), "no")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn(
        "level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(earlier), F.lit(0.0)))
        / F.sum("weight").over(later))
    # The first source in that order that the level of the rest does not carry over its limit.
    fits = F.when(F.col("level") * F.col("weight") <= F.col("bound"),
                  F.struct((F.col("bound") / F.col("weight")).alias("at"), "no", "level"))
    rows = rows.withColumn("cut", F.min(fits).over(everything))
    target = F.coalesce(F.least("bound", F.col("cut.level") * F.col("weight")), F.col("bound"))
    blocks = F.ceil(F.col("source_size") / float(block_words)).cast("long")
    rows = rows.withColumn("target", target).withColumn("blocks", blocks)
    slots = F.when(F.col("source_size") > 0, F.least(
        F.round(F.col("target") * F.col("blocks") / F.col("source_size")), most * F.col("blocks")))
    return rows.select("no", "source", "source_size", "docs", "target", "blocks",
                       F.coalesce(slots, F.lit(0)).cast("long").alias("slots"))


def offsets(sized: DataFrame, sources: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``sized`` with its source's row, ``offset`` (words of the source before it) and a row's (bucket, row).

    A source is cut into buckets by a hash of the id, so that no task sums up a whole
    one; a bucket begins where those before it end.
    """
    parts = F.greatest(F.ceil(F.col("docs") / float(bucket_rows)), F.lit(1)).cast("long")
    named = sources.withColumnRenamed("source", "_source")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "size"), parts))
    held = rows.groupBy("no", "bucket").agg(F.sum("size").alias("held"))
    before = Window.partitionBy("no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = held.select("no", "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("no", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "size")
    summed = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("inside", summed).withColumn("row", F.row_number().over(inside)).join(
        begins, ["no", "bucket"]).withColumn("offset", F.col("begin") + F.col("inside")).drop("begin", "inside")


def dealt(spark, sources: list, seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(no, blocks, shard, start, n): which of its slots each source gives to each shard.

    One number per source is held here; a shard's draws are multivariate hypergeometric,
    which is multinomial given the totals.
    """
    left = np.array([r["slots"] for r in sources], np.int64)
    given = np.zeros(len(left), np.int64)
    rng, rows, shard = np.random.default_rng(seed), [], 0
    while left.sum() > 0:
        size = int(min(shard_slots, left.sum()))
        drawn = _drawn(rng, left, size)
        for k in np.flatnonzero(drawn).tolist():
            rows.append((sources[k]["no"], sources[k]["blocks"], shard, int(given[k]), int(drawn[k])))
        left, given, shard = left - drawn, given + drawn, shard + 1
    return spark.createDataFrame(rows, "no int, blocks long, shard int, start long, n long")


def _drawn(rng, left: np.ndarray, size: int) -> np.ndarray:
    if left.sum() < 1_000_000_000:
        return rng.multivariate_hypergeometric(left, size, method="marginals")
    # Beyond the generator's range: multinomial by share, held to what is left.
    drawn = np.zeros_like(left)
    while (short := size - drawn.sum()) > 0:
        rest = left - drawn
        drawn += np.minimum(rng.multinomial(short, rest / rest.sum()), rest)
    return drawn


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 per key: a Feistel cipher, walked until in range."""
    bits = np.ones(len(index), np.uint64)
    for b in range(1, 32):
        bits = np.where(size > (1 << (2 * b)), np.uint64(b + 1), bits)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> bits[todo], out[todo] & mask[todo]
        for turn in range(4):
            x = (right + key[todo] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn)) * np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & mask[todo])
        out[todo] = left << bits[todo] | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _mapped(batches, seed: int):
    out = pa.schema([("no", pa.int32()), ("shard", pa.int32()), ("slot", pa.int64()), ("block", pa.int64())])
    for batch in batches:
        no, slot, blocks = (batch.column(c).to_numpy() for c in ("no", "slot", "blocks"))
        key = (slot // blocks).astype(np.uint64) * np.uint64(1 << 32) + no.astype(np.uint64) + np.uint64(seed << 20)
        yield batch_of(out, batch.column("no"), batch.column("shard"), batch.column("slot"),
                       permuted(slot % blocks, blocks, key))


def slots(spark, sources: DataFrame, seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(no, shard, slot, block): the mix, one row for each block taken."""
    plan = dealt(spark, sources.orderBy("no").collect(), seed, shard_slots)
    each = plan.repartition("no", "shard").select(
        "no", "blocks", "shard", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("slot"))
    mapped = each.mapInArrow(lambda b: _mapped(b, seed), "no int, shard int, slot long, block long")
    return stage(mapped, "slots")  # so that its true size decides how it is joined


def _blocks_of(block_words: int):
    first = F.floor(F.col("offset") / F.lit(block_words))
    last = F.floor((F.col("offset") + F.col("size") - 1) / F.lit(block_words))
    return F.when(F.col("size") > 0, F.sequence(first, last))


def taken(docs: DataFrame, seed: int = 3, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every document."""
    spark = docs.sparkSession
    sized = stage(sizes(docs), "sizes")
    sources = stage(targets(sized, block_words), "sources")
    times = stage(slots(spark, sources, seed).groupBy("no", "block").agg(F.count(F.lit(1)).alias("times")), "times")
    rows = offsets(sized, sources).withColumn("block", F.explode_outer(_blocks_of(block_words)))
    low = F.greatest(F.col("offset"), F.col("block") * block_words)
    high = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block_words)
    words = rows.withColumn("words", high - low).join(times, ["no", "block"], "left")
    return words.groupBy("no", "bucket", "row", "doc_id", "size", "source_size", "target").agg(
        F.coalesce(F.sum(F.col("words") * F.col("times")), F.lit(0)).cast("long").alias("taken"),
    ).select("doc_id", "size", "source_size", "target", "taken")


def _pieces(batches, block_words: int, schema: pa.Schema):
    for batch in batches:
        rows = zip(*[batch.column(n).to_pylist() for n in ("doc_id", "no", "offset", "text")])
        out: list[tuple] = []
        held = 0
        for doc_id, no, offset, text in rows:
            words = text.encode().split()  # bytes part at 0x20 and 0x09-0x0D only
            at = 0
            while at < len(words):
                block = (offset + at) // block_words
                to = min(len(words), (block + 1) * block_words - offset)
                out.append((no, block, offset + at, doc_id, to - at, b" ".join(words[at:to]).decode()))
                held += len(out[-1][-1])
                at = to
            if held > 4 << 20:
                yield batch_of(schema, *map(list, zip(*out)))
                out, held = [], 0
        if out:
            yield batch_of(schema, *map(list, zip(*out)))


def mixture(docs: DataFrame, seed: int = 3, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: (shard, source, slot, block, doc_id, place, words, text), a row per document in a slot."""
    spark = docs.sparkSession
    sources = stage(targets(sizes(docs), block_words), "sources")
    sized = sizes(docs, keep_text=True)  # counted again, which is cheaper than a copy of all texts
    schema = pa.schema([("no", pa.int32()), ("block", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()),
                        ("words", pa.int64()), ("text", pa.string())])
    placed = offsets(sized, sources).select("doc_id", "no", "offset", "text")
    pieces = placed.mapInArrow(lambda b: _pieces(b, block_words, schema),
                               "no int, block long, place long, doc_id long, words long, text string")
    return pieces.join(slots(spark, sources, seed), ["no", "block"]).join(
        F.broadcast(sources.select("no", "source")) if sources.count() <= 1000 else sources.select("no", "source"),
        "no").select("shard", "source", "slot", "block", "doc_id", "place", "words", "text")
