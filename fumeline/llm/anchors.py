"""Exact substring de-duplication with fixed-block anchors (operator 6).

A window is a number of consecutive words. Every window holds one aligned block of half
its length (rounded up), counted from the start of its document. These non-overlapping
blocks are the index; every rolling stretch of the same length in the corpus probes it.
Windows around blocks that are found more than once are candidates; a hit is extended by
comparing the whole windows, each with all others, and the union of repeated windows is
the maximal repeat.

Documents are dealt to chunks by a hash, and hashes of stretches to buckets, as sorted
arrays of eight bytes each; a chunk sends a stretch that it holds several times twice,
so a passage that all documents share costs two numbers per chunk. Windows are told
apart by 64 bits within a bucket that other bits choose, so the bits grow with the
number of buckets, which grows with the input.

Cases: a null or empty text has no words and nothing is removed from it. Texts shorter
than a window keep all words. Rows that repeat a document are documents of their own,
and so lose the windows that they share. Columns other than ``doc_id`` and ``text`` are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.llm.common import (
    PACKED, SPACES, Rolling, among, as_text, batch_of, delimiters, distinct, packed, slices, text_bytes, unpacked,
    word_bounds, word_hashes,
)
from fumeline.session import free, stage, unstage

WINDOW = 35
CHUNK = 8 << 20  # bytes of text in a chunk, about
BUCKET = 12 << 20  # bytes of text for each bucket of hashes

_SENT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("probes", pa.binary()), ("index", pa.binary())])
_FOUND = pa.schema([("chunk", pa.int64()), ("hashes", pa.binary())])
_DONE = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()),
                   ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("hashes", pa.binary())])
_DDL = {
    "sent": "bucket long, chunk long, probes binary, index binary",
    "found": "chunk long, hashes binary",
    "done": "chunk long, bucket long, doc_id long, text string, n_words long, n_removed long, kept string, hashes binary",
}


class Words:
    """The words of some texts: hashes, and for each place its text and how many words are left in it."""

    def __init__(self, part: pa.RecordBatch, which: int = 0):
        self.data, self.at = text_bytes(part.column("text"))
        self.starts, self.ends, self.first = word_bounds(self.data, self.at, delimiters(*SPACES))
        n = np.diff(self.first)
        self.inside = np.arange(len(self.starts)) - np.repeat(self.first[:-1], n)
        self.left = np.repeat(self.first[1:], n) - np.arange(len(self.starts))
        self.hashes = word_hashes(self.data, self.starts, self.ends, which)

    def windows(self, width: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of all windows that lie within a text."""
        hashes = Rolling(self.hashes, which).windows(width)
        places = np.flatnonzero(self.left[:len(hashes)] >= width)
        return places, hashes[places]


def _parts(table: pa.Table):
    for batch in unpacked(table).combine_chunks().to_batches():
        yield from slices(batch)


def _by_bucket(hashes: np.ndarray, bucket: np.ndarray, buckets: int):
    bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64)  # small numbers sort faster
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in range(buckets):
        if cuts[k] < cuts[k + 1]:
            yield k, hashes[order[cuts[k]:cuts[k + 1]]]


def _send(table: pa.Table, width: int, buckets: int) -> pa.Table:
    """A chunk's rolling stretches and aligned blocks, by bucket."""
    probes, index = [], []
    for part in _parts(table):
        words = Words(part)
        places, hashes = words.windows(width)
        probes.append(hashes)
        index.append(hashes[words.inside[places] % width == 0])
    probes, index = np.concatenate(probes), distinct(np.concatenate(index))
    chunk = table.column("chunk")[0].as_py()
    share = {k: h for k, h in _by_bucket(index, index % np.uint64(buckets), buckets)}
    rows = [(k, chunk, distinct(h, 2).tobytes(), share.get(k, index[:0]).tobytes())
            for k, h in _by_bucket(probes, probes % np.uint64(buckets), buckets)]
    return pa.Table.from_batches([batch_of(_SENT, *(map(list, zip(*rows)) if rows else [[]] * 4))])


def _numbers(column) -> list[np.ndarray]:
    return [np.frombuffer(v, np.uint64) for v in column.to_pylist()]


def _repeated(table: pa.Table) -> pa.Table:
    """For each chunk of a bucket, the indexed hashes that occur more than once in all chunks."""
    probes, index = _numbers(table.column("probes")), _numbers(table.column("index"))
    run = np.sort(np.concatenate(probes))
    again = distinct(run[1:][run[1:] == run[:-1]])
    rows = [(c, own[among(own, again)].tobytes())
            for c, own in zip(table.column("chunk").to_pylist(), index) if len(own)]
    rows = [r for r in rows if r[1]]
    return pa.Table.from_batches([batch_of(_FOUND, *(map(list, zip(*rows)) if rows else [[]] * 2))])


def _candidates(docs: pa.Table, found: pa.Table, window: int, width: int, buckets: int) -> pa.Table:
    """Texts without a repeated block are done; of the others, the windows to be compared."""
    hits = distinct(np.concatenate([np.zeros(0, np.uint64), *_numbers(found.column("hashes"))]))
    out, hashes, where = [], [], []
    chunk = docs.column("chunk")[0].as_py() if docs.num_rows else None
    for part in _parts(docs):
        words = Words(part)
        places, own = words.windows(width)
        aligned = words.inside[places] % width == 0
        hit = np.zeros(len(words.starts) + 2 * width, bool)
        hit[places[aligned]] = among(own[aligned], hits)
        start, whole = words.windows(window)
        # The one aligned block that lies within the window.
        block = start + -words.inside[start] % width
        chosen = hit[block]
        start, whole = start[chosen], whole[chosen]
        other = Words(part, 1).windows(window, 1)[1][chosen]
        hashes.append(whole)
        where.append(other % np.uint64(buckets))
        text = np.searchsorted(words.first, start, "right") - 1
        waiting = np.zeros(part.num_rows, bool)
        waiting[text] = True
        n = np.diff(words.first)
        texts = part.column("text").to_pylist()
        none = [None] * part.num_rows
        out.append(batch_of(
            _DONE, [chunk] * part.num_rows, none, part.column("doc_id"),
            [t if w else None for t, w in zip(texts, waiting)], n,
            [None if w else 0 for w in waiting],
            [None if w else b" ".join(t.encode().split()).decode() for t, w in zip(texts, waiting)], none))
    if hashes:
        for k, own in _by_bucket(np.concatenate(hashes), np.concatenate(where), buckets):
            out.append(batch_of(_DONE, [chunk], [k], [None], [None], [None], [None], [None], [distinct(own, 2).tobytes()]))
    return pa.Table.from_batches(out, _DONE)


def _removed(docs: pa.Table, found: pa.Table, window: int) -> pa.Table:
    """Texts without the words of repeated windows."""
    again = distinct(np.concatenate([np.zeros(0, np.uint64), *_numbers(found.column("hashes"))]))
    out = []
    for part in _parts(docs):
        words = Words(part)
        places, own = words.windows(window)
        places = places[among(own, again)]
        edge = np.zeros(len(words.starts) + 1, np.int64)
        edge[places] += 1
        edge[places + window] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        kept, removed, whole = [], [], words.data.tobytes()
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            stay = a + np.flatnonzero(~gone[a:b])
            kept.append(b" ".join(whole[s:e] for s, e in zip(
                words.starts[stay].tolist(), words.ends[stay].tolist())).decode())
            removed.append(b - a - len(stay))
        none = [None] * part.num_rows
        out.append(batch_of(_DONE, none, none, part.column("doc_id"), none,
                            np.diff(words.first), removed, kept, none))
    return pa.Table.from_batches(out, _DONE)


def chunks_of(docs: DataFrame, chunk: int = CHUNK, bucket: int = BUCKET) -> tuple[DataFrame, int]:
    """Bundles of documents dealt evenly by a hash, and the number of buckets for this much text."""
    read = docs.select(F.col("doc_id").cast("long"), as_text())
    size = read.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    count = max(1, -(-int(size) // chunk))
    dealt = read.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)))
    return dealt.select("chunk", "doc_id", "text").mapInArrow(packed, PACKED), max(1, -(-int(size) // bucket))


def deduplicated(docs: DataFrame, window: int = WINDOW, chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words of no window that starts elsewhere too, joined by a space."""
    width = (window + 1) // 2
    dealt, buckets = chunks_of(docs, chunk, bucket)
    sent = dealt.groupBy("chunk").applyInArrow(lambda t: _send(t, width, buckets), _DDL["sent"])
    found = stage(sent.groupBy("bucket").applyInArrow(_repeated, _DDL["found"]), "blocks")
    del sent
    free(docs.sparkSession)  # the probes' shuffles, before the texts are shuffled again
    judged = stage(dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        lambda d, f: _candidates(d, f, window, width, buckets), _DDL["done"]), "candidates")
    unstage(found)
    windows = judged.filter(F.col("bucket").isNotNull()).select(
        "bucket", "chunk", F.col("hashes").alias("probes"), F.col("hashes").alias("index"))
    again = windows.groupBy("bucket").applyInArrow(_repeated, _DDL["found"])
    waiting = judged.filter(F.col("text").isNotNull()).select("chunk", "doc_id", "text").mapInArrow(packed, PACKED)
    cut = waiting.groupBy("chunk").cogroup(again.groupBy("chunk")).applyInArrow(
        lambda d, f: _removed(d, f, window), _DDL["done"])
    done = judged.filter(F.col("kept").isNotNull())
    names = ("doc_id", "n_words", "n_removed", "kept")
    return done.select(*names).unionByName(cut.select(*names))
