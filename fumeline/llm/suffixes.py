"""Exact de-duplication of repeated byte strings by difference-cover sampling (operator 5).

A difference cover modulo 57 has eight residues such that any two positions reach, within
56 steps, two sampled positions at the same time. So two equal strings of 100 bytes always
hold two equal sampled strings of 44 bytes. In a first round the sampled suffixes of all
documents are named by a hash of their first 44 bytes; in the second round the remaining
suffixes, those with a repeated sample within reach, are named by a hash of their first 100
bytes. Equality of 64-bit hashes stands in for sorting suffixes: hashes are sorted and equal
ones match. No suffix is ordered by its bytes, and matches are not compared byte by byte.

Names are 64-bit fingerprints from one running sum (within a bucket that other bits of a
second fingerprint choose, where they decide), not ranks: a name of any length costs the
same, so there is no recursion on names, and no rank has to travel. Documents are dealt
to chunks by ranges of their id, so a lower chunk means an earlier place; within a chunk
places are compared directly. A chunk sends each distinct name once, sorted, as eight
bytes; the answer is one bit per name.

Cases: a null or empty text has no bytes. Texts under 100 bytes keep all. A null id comes
after all others. Rows of one id are compared by place alone: of equal places neither is
earlier. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.llm.common import (
    PACKED, Rolling, among, as_text, batch_of, byte_values, distinct, packed, slices, text_bytes, unpacked,
)
from fumeline.session import free, stage

LENGTH = 100
# A perfect difference set modulo 57.
MODULUS, COVER = 57, (1, 6, 7, 9, 19, 38, 42, 49)
CHUNK = 4 << 20  # bytes of text in a chunk, about
BUCKET = 12 << 20  # bytes of text for each bucket of names
TURNS = 2  # in which the second round's buckets are gone through

_SENT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("names", pa.binary())])
_SENT_DDL = "bucket long, chunk long, names binary"
_BITS = pa.schema([("of", pa.int64()), ("bucket", pa.int64()), ("bits", pa.binary())])
_BITS_DDL = "of long, bucket long, bits binary"
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                  ("n_spans", pa.int64()), ("kept", pa.binary())])
_OUT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


class Bytes:
    """The bytes of some texts, with what is left of its text at each place."""

    def __init__(self, part: pa.RecordBatch):
        self.data, self.at = text_bytes(part.column("text"))
        n = np.diff(self.at)
        self.inside = np.arange(len(self.data)) - np.repeat(self.at[:-1], n)
        self.left = np.repeat(self.at[1:], n) - np.arange(len(self.data))
        self.roll = Rolling(byte_values()[self.data])

    def samples(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, names): the sampled suffixes by their first bytes, in texts that can hold a repeat."""
        width = length - MODULUS + 1
        chosen = np.zeros(MODULUS, bool)
        chosen[list(COVER)] = True
        places = np.flatnonzero((self.left >= width) & (self.inside + self.left >= length)
                                & chosen[self.inside % MODULUS])
        return places, self.roll.of(places, places + width)

    def windows(self, hit: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, names): the suffixes with a place of ``hit`` in reach, by their first bytes."""
        reach = np.zeros(len(self.data) + MODULUS + 1, np.int32)
        np.cumsum(hit, out=reach[1:len(hit) + 1])
        reach[len(hit) + 1:] = reach[len(hit)]
        near = reach[MODULUS:MODULUS + len(hit)] > reach[:len(hit)]
        places = np.flatnonzero(near & (self.left >= length))
        return places, self.roll.of(places, places + length)

    def buckets(self, places: np.ndarray, length: int, buckets: int) -> np.ndarray:
        """The bucket of each suffix, from a second fingerprint."""
        other = Rolling(byte_values(1)[self.data], 1).of(places, places + length)
        return (other % np.uint64(buckets)).astype(np.int64)


def _parts(table: pa.Table):
    """A chunk's texts in the order of their ids, in slices."""
    table = unpacked(table)
    order = table.select(["doc_id"]).add_column(0, "row", pa.array(np.arange(table.num_rows))).sort_by(
        [("doc_id", "ascending")]).column("row")  # nulls last
    for batch in table.take(order).combine_chunks().to_batches():
        yield from slices(batch)


def _distinct(names: np.ndarray, bucket: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Sorted distinct names, by bucket."""
    kind = np.uint16 if buckets <= 1 << 16 else np.int64
    order = np.argsort(bucket.astype(kind), kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [distinct(names[order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]


def _sent(chunk: int, names: list[np.ndarray]) -> pa.Table:
    rows = [(k, chunk, own.tobytes()) for k, own in enumerate(names) if len(own)]
    return pa.Table.from_batches([batch_of(_SENT, *(map(list, zip(*rows)) if rows else [[]] * 3))])


def _first_round(docs: pa.Table, length: int, buckets: int) -> list[np.ndarray]:
    names = [Bytes(part).samples(length)[1] for part in _parts(docs)]
    names = np.concatenate([np.zeros(0, np.uint64), *names])
    return _distinct(names, (names % np.uint64(buckets)).astype(np.int64), buckets)


def _again(table: pa.Table, earlier: bool) -> pa.Table:
    """One bit per name of each chunk: do other chunks (or earlier ones) have it?"""
    table = table.sort_by([("chunk", "ascending")])
    own = [np.frombuffer(v, np.uint64) for v in table.column("names").to_pylist()]
    names = np.concatenate(own)
    order = np.argsort(names, kind="stable")  # equal names in the order of their chunks
    run = names[order]
    same = run[1:] == run[:-1]
    bit = np.zeros(len(names), bool)
    bit[order[1:]] = same
    if not earlier:
        bit[order[:-1]] |= same
    ends = np.cumsum([len(o) for o in own])
    bits = [np.packbits(bit[e - len(o):e]).tobytes() for o, e in zip(own, ends)]
    return pa.Table.from_batches([batch_of(_BITS, table.column("chunk").combine_chunks(),
                                           table.column("bucket").combine_chunks(), bits)])


def _told(answer: pa.Table, names: list[np.ndarray]) -> list[np.ndarray]:
    """The names of each bucket that the answer says yes to."""
    held = dict(zip(answer.column("bucket").to_pylist(), answer.column("bits").to_pylist()))
    out = []
    for k, own in enumerate(names):
        bits = np.frombuffer(held[k], np.uint8) if k in held else np.zeros(0, np.uint8)
        out.append(own[np.unpackbits(bits, count=len(own)).astype(bool)] if len(own) else own)
    return out


def _live(docs: pa.Table, answer: pa.Table, length: int, buckets: int):
    """For each slice of a chunk: (texts, places, names, buckets) of the suffixes that remain."""
    kept, names = [], []
    for part in _parts(docs):
        text = Bytes(part)
        places, own = text.samples(length)
        names.append(own)
        kept.append((part, places))
    everything = np.concatenate([np.zeros(0, np.uint64), *names])
    held = _distinct(everything, (everything % np.uint64(buckets)).astype(np.int64), buckets)
    run = distinct(everything, 2)
    again = distinct(np.concatenate([run[1:][run[1:] == run[:-1]], *_told(answer, held)]))
    del everything, held, run
    for (part, places), own in zip(kept, names):
        text = Bytes(part)
        hit = np.zeros(len(text.data), bool)
        hit[places[among(own, again)]] = True
        live, windows = text.windows(hit, length)
        yield part, text, live, windows, text.buckets(live, length, buckets) if len(live) else live


def _second_round(docs: pa.Table, answer: pa.Table, length: int, buckets: int, turn: int) -> list[np.ndarray]:
    """The names of the buckets whose turn it is."""
    names, bucket = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, _, own, of in _live(docs, answer, length, buckets):
        chosen = of % TURNS == turn
        names.append(own[chosen])
        bucket.append(of[chosen])
    return _distinct(np.concatenate(names), np.concatenate(bucket), buckets)


def _places(held: list) -> np.ndarray:
    """The places of a chunk's suffixes as numbers in their order; rows of one id share theirs."""
    ids, last = [], (None, -1)
    for part, *_ in held:
        for doc in part.column("doc_id").to_pylist():
            last = (doc, last[1] + (doc != last[0] or last[1] < 0))
            ids.append(last[1])
    out, row = [np.zeros(0, np.int64)], 0
    for part, text, live, *_ in held:
        of = np.searchsorted(text.at, live, "right") - 1
        out.append((np.array(ids[row:row + part.num_rows], np.int64)[of] << 40) + text.inside[live])
        row += part.num_rows
    return np.concatenate(out)


def _numbered(batches, bounds: np.ndarray):
    schema = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string())])
    for batch in batches:
        ids = batch.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
        yield batch_of(schema, np.searchsorted(bounds, ids, "left"), batch.column("doc_id"), batch.column("text"))


def _cut(docs: pa.Table, answers: pa.Table, length: int, buckets: int) -> pa.Table:
    """Texts without the bytes of strings that also start earlier."""
    first = answers.filter(pc.equal(answers.column("round"), 1))
    second = answers.filter(pc.equal(answers.column("round"), 2))
    held = list(_live(docs, first, length, buckets))
    names = np.concatenate([np.zeros(0, np.uint64), *[h[3] for h in held]])
    bucket = np.concatenate([np.zeros(0, np.int64), *[h[4] for h in held]])
    earlier = _told(second, _distinct(names, bucket, buckets))
    gone = np.zeros(len(names), bool)
    order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    key = _places(held)
    for k in range(buckets):
        own = order[cuts[k]:cuts[k + 1]]
        if not len(own):
            continue
        mine = names[own]
        gone[own] = among(mine, earlier[k])
        # Of the others, those that the chunk holds several times stay at their least place.
        run = distinct(mine, 2)
        own = own[among(mine, run[1:][run[1:] == run[:-1]]) & ~gone[own]]
        if len(own):
            value, back = np.unique(names[own], return_inverse=True)
            least = np.full(len(value), np.iinfo(np.int64).max)
            np.minimum.at(least, back, key[own])
            gone[own] = key[own] > least[back]
    out, at = [], 0
    for part, text, live, _, _ in held:
        here = live[gone[at:at + len(live)]]
        at += len(live)
        edge = np.zeros(len(text.data) + 1, np.int32)
        edge[here] += 1  # places are distinct
        edge[here + length] -= 1
        cut = np.cumsum(edge)[:-1] > 0
        opens = cut.copy()
        opens[1:] &= ~cut[:-1]
        starts = text.at[:-1][text.at[:-1] < len(cut)]
        opens[starts] = cut[starts]
        removed, spans = np.append(0, np.cumsum(cut)), np.append(0, np.cumsum(opens))
        whole = text.data.tobytes()
        kept = []
        for a, b in zip(text.at[:-1].tolist(), text.at[1:].tolist()):
            kept.append(whole[a:b] if removed[b] == removed[a] else text.data[a:b][~cut[a:b]].tobytes())
        out.append(batch_of(_OUT, part.column("doc_id"), np.diff(text.at), removed[text.at[1:]] - removed[text.at[:-1]],
                            spans[text.at[1:]] - spans[text.at[:-1]], kept))
    return pa.Table.from_batches(out, _OUT)


def deduplicated(docs: DataFrame, length: int = LENGTH, chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): texts without bytes of strings that start earlier too.

    ``length`` is more than 57 bytes.
    """
    read = docs.select(F.col("doc_id").cast("long"), as_text())
    size = int(read.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0])
    chunks, buckets = max(1, -(-size // chunk)), max(1, -(-size // bucket))
    # One bound per chunk.
    bounds = read.agg(F.percentile_approx(
        "doc_id", F.array(*[F.lit(k / chunks) for k in range(1, chunks)]) if chunks > 1 else F.array(F.lit(1.0)),
        max(10_000, 20 * chunks))).first()[0] or []
    bounds = sorted(set(bounds))
    dealt = read.mapInArrow(lambda b: packed(_numbered(b, np.array(bounds, np.int64))), PACKED)

    def answer(sent: DataFrame, earlier: bool, name: str) -> DataFrame:
        told = sent.groupBy("bucket").applyInArrow(lambda t: _again(t, earlier), _BITS_DDL)
        return stage(told.withColumn("round", F.lit(2 if earlier else 1)), name)

    first = answer(dealt.groupBy("chunk").applyInArrow(
        lambda t: _sent(t.column("chunk")[0].as_py(), _first_round(t, length, buckets)), _SENT_DDL), False, "sampled")
    free(read.sparkSession)
    def remaining(turn: int):
        return lambda t, a: _sent(t.column("chunk")[0].as_py() if t.num_rows else 0,
                                  _second_round(t, a, length, buckets, turn))

    answers = first
    for turn in range(TURNS):  # half of the names at a time are on disk
        second = answer(dealt.groupBy("chunk").cogroup(first.groupBy("of")).applyInArrow(
            remaining(turn), _SENT_DDL), True, "remaining")
        answers = answers.unionByName(second)
        free(read.sparkSession)
    return dealt.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(
        lambda t, a: _cut(t, a, length, buckets), _OUT_DDL)
