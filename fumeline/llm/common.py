"""Shared by the operators: text batches as byte arrays, rolling hashes, fixed remainders.

Words are runs of bytes other than space and 0x09-0x0D unless an operator says otherwise.
All of these delimiters are single bytes of UTF-8, so words can be cut from bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20  # bytes of text that a task turns into arrays at once


class _Kept(dict):
    """What a Python process keeps for itself; tasks are sent without it."""

    def __reduce__(self):
        return _Kept, ()


_kept = _Kept()  # powers for rolling hashes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batches_of(spark: SparkSession, size: str = "8m") -> None:
    """Set how much a task hands to Python at once, from now on in this session.

    By default that is 64 MB, which the JVM and Python each hold, whole and in parts.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id's text, modulo ``modulus``; -1 for a null id."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)), F.lit(-1)).cast("int")


def as_text(column: str = "text") -> Column:
    """A text column where null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def fresh(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that is not in use (names differ by more than case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``most`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    ends = _offsets(batch.column(column))[1:]
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else _offsets(batch.column(column))[0]
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _offsets(texts: pa.Array) -> np.ndarray:
    raw = np.frombuffer(texts.buffers()[1], np.int32)
    return raw[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array one after another, and where each text starts (and the end)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = _offsets(texts)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[at[0]:at[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def delimiters(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans: is a byte part of a word, given the ranges that are not."""
    inside = np.ones(256, bool)
    for low, high in ranges:
        inside[low:high + 1] = False
    return inside


SPACES = ((0x20, 0x20), (0x09, 0x0D))


def word_bounds(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the words of all texts, and the number of words before each text (and in all)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    word = inside[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    cuts = at[1:-1]
    cuts = cuts[cuts < len(data)]
    begins[cuts] = word[cuts]
    starts = np.flatnonzero(begins)
    final = word.copy()
    final[:-1] &= ~word[1:]
    before = at[1:-1]
    before = before[(before > 0) & (before < len(data))] - 1
    final[before] = word[before]
    return starts, np.flatnonzero(final) + 1, np.searchsorted(starts, at)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values (splitmix64's finisher)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    held = _kept.get(which)
    if held is None or len(held[0]) < n:
        base = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[which]
        size = max(n, CHUNK_BYTES + 4096)
        pair = []
        for p in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, p, np.uint64)
            steps[0] = 1
            pair.append(np.cumprod(steps))
        _kept[which] = held = tuple(pair)
    return held


def byte_values(which: int = 0) -> np.ndarray:
    """A fixed 64-bit value per byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(which))


class Rolling:
    """Hashes of any stretches of a sequence, from one running sum.

    The sum of value(i) * base^i over a stretch, times base^-start, depends on the
    stretch's content only.
    """

    def __init__(self, values: np.ndarray, which: int = 0):
        self.up, self.down = _powers(which, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[:len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def windows(self, width: int) -> np.ndarray:
        """The hash of every window of ``width`` values."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return Rolling(byte_values(which)[data], which).of(starts, ends)


def distinct(values: np.ndarray, most: int = 1) -> np.ndarray:
    """Sorted values, each up to ``most`` times (1 or 2). Sorting beats numpy's hashing here."""
    run = np.sort(values)
    keep = np.ones(len(run), bool)
    if len(run) > most:
        keep[most:] = run[most:] != run[:-most]
    return run[keep]


def among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values


PACKED = "chunk long, rows binary"


def packed(batches) -> Iterator[pa.RecordBatch]:
    """Rows with a ``chunk`` as compressed bundles of a chunk's rows, which shuffle in less space."""
    out = pa.schema([("chunk", pa.int64()), ("rows", pa.binary())])
    option = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        for part in slices(batch, most=16 << 20):
            chunk = part.column("chunk").to_numpy()
            order = np.argsort(chunk, kind="stable")
            held, cuts = np.unique(chunk[order], return_index=True)
            for k, own in zip(held.tolist(), np.split(order, cuts[1:])):
                sink = pa.BufferOutputStream()
                rows = part.take(pa.array(own)).select(["doc_id", "text"])
                with pa.ipc.new_stream(sink, rows.schema, options=option) as stream:
                    stream.write_batch(rows)
                yield batch_of(out, [k], [sink.getvalue().to_pybytes()])


def unpacked(table: pa.Table) -> pa.Table:
    """The rows (doc_id, text) of a chunk's bundles."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    tables = [pa.ipc.open_stream(rows).read_all().cast(schema) for rows in table.column("rows").to_pylist()]
    return pa.concat_tables([schema.empty_table(), *tables])


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )
