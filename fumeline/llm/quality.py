"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL (operator 9).

A text is cut into runs of word characters and runs of punctuation. Each run, each pair
of neighbours, and each run that equals the one before it are hashed to one of 2^18
features; a feature's value is its count over the square root of the number of features.
Weights come from follow-the-regularised-leader updates over a bounded sample of the
labelled rows, and every text is scored by a sparse dot product.

Cases: a null or empty text has no features and scores the bias alone. Labels that are
null, or whose document is missing, teach nothing; of several labels of a document the
largest counts. Without any usable label every score is 0.5. Repeated documents are
scored each by itself. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fumeline.llm.common import as_text, batch_of, byte_values, mix, slices, text_bytes, Rolling

BITS = 18
SAMPLE_ROWS = 4000  # labelled rows that the model is fitted on, at most


def _classes() -> np.ndarray:
    """0 for a space or control byte, 1 for a word byte, 2 for punctuation."""
    kind = np.full(256, 2, np.uint8)
    kind[:0x21] = 0
    kind[0x7F] = 0
    kind[0x80:] = 1
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
        kind[low:high + 1] = 1
    return kind


def features(data: np.ndarray, at: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first): the hashed features of all texts, and where each text's begin (and the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    kind = _classes()[data]
    change = np.ones(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    cuts = at[1:-1]
    change[cuts[cuts < len(data)]] = True
    edges = np.flatnonzero(change)
    ends = np.append(edges[1:], len(data))
    real = kind[edges] > 0
    starts, ends = edges[real], ends[real]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    one = Rolling(byte_values()[data]).of(starts, ends)
    first = np.searchsorted(starts, at)
    opens = np.zeros(len(one), bool)
    opens[first[:-1][first[:-1] < len(one)]] = True
    last = np.where(opens, np.uint64(1), np.roll(one, 1))
    pair = mix(last * np.uint64(0x9E3779B97F4A7C15) + one)
    pair[(last == one) & ~opens] = np.uint64(0x5EED)
    mask = np.uint64((1 << bits) - 1)
    ids = np.empty(2 * len(one), np.int64)
    ids[0::2], ids[1::2] = mix(one + np.uint64(1)) & mask, mix(pair) & mask
    return ids, first * 2


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], bits: int = BITS,
         epochs: int = 5, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02,
         l2: float = 0.05) -> np.ndarray:
    """Weights of all features, the bias last, from rows of (feature ids, values)."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(z[i]) <= l1, 0.0, w)

    order = np.random.default_rng(9)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            i, x = rows[k]
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
            g = (p - labels[k]) * x
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / alpha * w
            n[i] = grown
    return weights(np.arange((1 << bits) + 1))


def _counts(batches, bits: int):
    out = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())])
    for batch in batches:
        for part in slices(batch):
            ids, first = features(*text_bytes(part.column("text")), bits)
            packed = [np.unique(ids[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:])]
            yield batch_of(out, part.column("doc_id"), part.column("label"),
                           [i.astype(np.int32).tobytes() for i, _ in packed],
                           [c.astype(np.int32).tobytes() for _, c in packed])


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column | None = None,
        sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> np.ndarray:
    """Weights learned from at most ``sample_rows`` labelled documents, picked by a hash of the id.

    ``learn`` tells which rows of ``labels`` may be learned from.
    """
    chosen = sample_labels(labels, label, learn, sample_rows)
    rows = docs.select(F.col("doc_id").cast("long"), as_text()).join(F.broadcast(chosen), "doc_id").mapInArrow(
        lambda batches: _counts(batches, bits), "doc_id long, label int, ids binary, counts binary",
    ).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["label"], bytes(r["ids"]), bytes(r["counts"])))
    given = []
    for r in rows:
        i, c = np.frombuffer(r["ids"], np.int32), np.frombuffer(r["counts"], np.int32)
        x = np.append(c / np.sqrt(max(1, c.sum())), 1.0)
        given.append((np.append(i, 1 << bits).astype(np.int64), x))
    return ftrl(given, [r["label"] for r in rows], bits)


def sample_labels(labels: DataFrame, label: str, learn: Column | None, sample_rows: int) -> DataFrame:
    """At most ``sample_rows`` rows (doc_id, label), the first by a hash of the id: a bounded table."""
    usable = F.col(label).isNotNull() & F.col("doc_id").isNotNull()
    given = labels.filter(usable if learn is None else usable & learn)
    given = given.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)


def _probabilities(part: pa.RecordBatch, weights: np.ndarray, bits: int) -> np.ndarray:
    """The probability of label 1 for each text of a batch."""
    ids, first = features(*text_bytes(part.column("text")), bits)
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    sums = np.bincount(row, weights[ids], len(n))  # each text's own sum, whatever its neighbours
    margin = weights[-1] + sums / np.sqrt(np.maximum(n, 1))
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _scores(batches, weights: np.ndarray, bits: int):
    out = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    for batch in batches:
        for part in slices(batch):
            yield batch_of(out, part.column("doc_id"), _probabilities(part, weights, bits))


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """(doc_id, score): the probability of label 1 for every text."""
    weights = weights.astype(np.float32)
    return docs.select(F.col("doc_id").cast("long"), as_text()).mapInArrow(
        lambda batches: _scores(batches, weights, bits), "doc_id long, score double"
    )


def _keep(batches, weights: np.ndarray, bits: int, least: float):
    for batch in batches:
        for part in slices(batch):
            yield part.filter(pa.array(_probabilities(part, weights, bits) >= least))


def accepted(docs: DataFrame, weights: np.ndarray, least: float, bits: int = BITS) -> DataFrame:
    """The documents, whole and with all their columns, that score at least ``least``."""
    weights = weights.astype(np.float32)
    return docs.withColumn("text", as_text()).mapInArrow(
        lambda batches: _keep(batches, weights, bits, least), docs.schema
    )
