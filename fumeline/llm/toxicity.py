"""Toxicity by compression distance with two zstandard dictionaries (operator 1).

Two dictionaries are trained on labelled text. What is peculiar to the toxic one are byte
strings, from anywhere in a text and across words, that significantly more toxic documents
hold than the ordinary ones would lead one to expect. The ordinary dictionary is trained by
zstandard on those ordinary windows that such strings shorten by chance; the toxic one holds
it too, so that only what is peculiar remains as a difference. A text is cut into windows of
a few words, and every window is compressed with either dictionary; what the toxic one saves
over the other is the window's evidence. Dictionaries and windows share a primer, so that
every window pays for its first match and a telling string shows in full. How many and what
share of a text's windows save as much as each of some thresholds is turned into a
probability by a logistic fit on the same sample, which calibrates the thresholds. Near copies in
the sample teach once, or their chance wording would look telling.

Windows longer than ``MOST`` bytes (scripts without spaces, run-together text) are cut into
overlapping ones, so a telling string counts wherever it stands.

Cases: a null or empty text has no window and scores as a text without evidence. Labels
that are null, or whose document is missing, teach nothing; of several labels of a
document the largest counts. If a class has no labelled text every score is the share of
toxic labels, 0 without labels. Repeated documents are scored each by itself. Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fumeline.llm.common import (SPACES, Rolling, among, as_text, batch_of, byte_values, delimiters, mix, slices,
                                 text_bytes, word_bounds)
from fumeline.session import stage, unstage

SAMPLE_ROWS = 3000  # labelled documents of each class that are learned from, at most
SEED_ROWS = 600  # of these, toxic documents whose strings may become part of the dictionary
HARD_ROWS = 50_000  # ordinary windows that the ordinary dictionary is trained on, at most
HARD = 2  # bytes that toxic strings save in such a window, at least
SIZE, SEGMENT, GRAM = 32_768, 8, 6  # of the trained dictionary, of its segments, of what they are chosen by, in bytes
THRESHOLDS = (2, 3, 4, 5, 6, 8, 10)  # bytes saved; how much each counts for is calibrated
WORDS = 4  # of a window
MOST, STEP = 96, 64  # bytes of a window, and from one to the next where a longer one is cut
SIZES = (5, 6, 7, 8, 9, 10, 12, 15, 18, 24)  # bytes of strings that are counted
LEAST_DOCS = 5  # of its class that hold a string
LEAST_Z = 7.0  # standard deviations above what the other class leads one to expect
LEAST_RATIO = 6.0  # times as frequent as in the other class
LONGER = 2.0  # how much more telling a string must be than one within it that is taken
PARTS = 64  # that the strings' hashes are dealt to
LEVEL = 1
MATCH = 5  # bytes of the shortest match
PRIMER = bytes([1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 17, 18, 19, 20, 21])
TAIL = b" " + bytes(range(22, 30))  # matches are not looked for in the last eight bytes


class Model(NamedTuple):
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]


_PLAIN = np.where(delimiters(*SPACES), np.arange(256), 0x20).astype(np.uint8)


def _lowered(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, at = text_bytes(part.column("text"))
    return _PLAIN[np.frombuffer(data.tobytes().lower(), np.uint8)], at  # bytes: only A-Z change


def _strings(data: np.ndarray, sizes=SIZES):
    """(size, starts, hashes) of a text's strings that begin and end between characters."""
    roll, edge = Rolling(byte_values()[data]), np.append((data & 0xC0) != 0x80, True)
    for size in sizes:
        n = len(data) - size + 1
        if n > 0:
            starts = np.flatnonzero(edge[:n] & edge[size:size + n])
            yield size, starts, roll.windows(size)[starts] + np.uint64(size)


def _distinct(data: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, _, h in _strings(data))]))


_MARKED = "doc_id long, text string, label int, one long, two long"


def _marked(batches):
    """Rows with two marks, each of which most near copies share: least hashes of their strings of 12 bytes."""
    out = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("label", pa.int32()), ("one", pa.int64()),
                     ("two", pa.int64())])
    for batch in batches:
        for part in slices(batch):
            data, at = _lowered(part)
            marks = np.zeros((2, part.num_rows), np.uint64)
            for k in range(part.num_rows):
                own = data[at[k]:at[k + 1]]
                held = Rolling(byte_values()[own]).windows(min(12, len(own)))
                if len(held):
                    marks[:, k] = held.min(), mix(held ^ np.uint64(1)).min()
            yield batch_of(out, *(part.column(n) for n in ("doc_id", "text", "label")), *marks.view(np.int64))


def _seeds(batches):
    """Each document's distinct strings as hashes, dealt to parts."""
    out = pa.schema([("part", pa.int32()), ("held", pa.binary())])
    for batch in batches:
        for part in slices(batch):
            data, at = _lowered(part)
            held = np.concatenate([_distinct(data[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())])
            held.sort()
            cuts = np.searchsorted(held, np.arange(1, PARTS, dtype=np.uint64) * np.uint64((1 << 64) // PARTS))
            yield batch_of(out, list(range(PARTS)), [r.tobytes() for r in np.split(held, cuts)])


def _frequent(rows: pa.Table) -> pa.Table:
    """The strings that enough documents hold."""
    held, n = np.unique(np.frombuffer(b"".join(rows.column("held").to_pylist()), np.uint64), return_counts=True)
    return pa.table({"hash": pa.array(held[n >= LEAST_DOCS].view(np.int64), pa.int64())})


def _counted(batches, seeds: np.ndarray):
    """How many documents of either class hold each of the seeds, in this task."""
    counts = np.zeros((2, len(seeds)), np.int64)
    for batch in batches:
        for part in slices(batch):
            data, at = _lowered(part)
            for k, label in enumerate(part.column("label").to_pylist()):
                held = _distinct(data[at[k]:at[k + 1]])
                counts[label, np.searchsorted(seeds, held[among(held, seeds)])] += 1
    met = np.flatnonzero(counts.sum(0))
    out = pa.schema([("hash", pa.int64()), ("t", pa.int64()), ("o", pa.int64())])
    yield batch_of(out, seeds[met].view(np.int64), counts[1, met], counts[0, met])


def _named(batches, wanted: np.ndarray):
    """The bytes behind hashes, as far as this task's texts hold them."""
    found: dict[int, bytes] = {}
    for batch in batches:
        for part in slices(batch):
            data, at = _lowered(part)
            for k in range(part.num_rows):
                own = data[at[k]:at[k + 1]]
                for size, starts, hashes in _strings(own):
                    hit = np.flatnonzero(among(hashes, wanted))
                    for h, s in zip(hashes[hit].tolist(), starts[hit].tolist()):
                        if h not in found:
                            found[h] = own[s:s + size].tobytes()
    out = pa.schema([("hash", pa.int64()), ("string", pa.binary())])
    yield batch_of(out, np.array(list(found), np.uint64).view(np.int64), list(found.values()))


def windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the windows of all texts."""
    starts, ends, first = word_bounds(data, at, delimiters(*SPACES))
    inside = np.arange(len(starts)) - np.repeat(first[:-1], np.diff(first))
    begin = np.flatnonzero(inside % WORDS == 0)
    text = np.searchsorted(first, begin, "right") - 1
    start, end = starts[begin], ends[np.minimum(begin + WORDS, first[text + 1]) - 1]
    pieces = np.maximum(0, -(-(end - start - MOST) // STEP)) + 1
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    text, start, end = (np.repeat(x, pieces) for x in (text, start, end))
    start = start + number * STEP
    return text, start, np.where(end - start > MOST, start + MOST, end)


def savings(data: np.ndarray, at: np.ndarray, coders: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(text, saving) of every window: bytes that the toxic dictionary saves over the ordinary one."""
    text, start, end = windows(data, at)
    whole, sizes = data.tobytes(), []
    held = [PRIMER + b" " + whole[s:e] + TAIL for s, e in zip(start.tolist(), end.tolist())]
    for coder in coders:
        sizes.append(np.fromiter((len(coder.compress(w)) for w in held), np.int64, len(held)))
    return text, sizes[1] - sizes[0]


def _coders(model: Model):
    made = []
    setting = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=MATCH, write_checksum=False, write_content_size=False, write_dict_id=False)
    for content in (model.toxic, model.ordinary):
        given = zstandard.ZstdCompressionDict(content + PRIMER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        given.precompute_compress(compression_params=setting)
        made.append(zstandard.ZstdCompressor(dict_data=given, compression_params=setting))
    return tuple(made)


def _evidence(text: np.ndarray, saving: np.ndarray, texts: int) -> np.ndarray:
    """Per text: a constant; the log numbers of its windows, and of those that save as much as each threshold; shares."""
    windows = np.bincount(text, minlength=texts)
    counts = [np.bincount(text[saving >= least], minlength=texts) for least in THRESHOLDS]
    shares = [10 * c / np.maximum(windows, 1) for c in counts]
    return np.stack([np.ones(texts), np.log1p(windows), *map(np.log1p, counts), *shares], axis=1)


def _histograms(batches, model: Model):
    """Per document, how many windows save 0, 1, ... 31 or more bytes."""
    out = pa.schema([("label", pa.int32()), ("held", pa.list_(pa.int32()))])
    coders = _coders(model)
    for batch in batches:
        for part in slices(batch):
            text, saving = savings(*_lowered(part), coders)
            held = np.zeros((part.num_rows, 32), np.int64)
            np.add.at(held, (text, np.clip(saving, 0, 31)), 1)
            yield batch_of(out, part.column("label"), held.tolist())


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample_rows: int = SAMPLE_ROWS,
        seed_rows: int = SEED_ROWS) -> Model:
    """Dictionaries and calibration from at most ``sample_rows`` labelled documents of each class."""
    usable = F.lit(True) if learn is None else learn
    chosen = _class(labels, usable, 1, sample_rows).unionByName(_class(labels, usable, 0, sample_rows))
    marked = docs.select(F.col("doc_id").cast("long"), as_text()).join(
        F.broadcast(chosen), "doc_id").select("doc_id", "text", "label").mapInArrow(_marked, _MARKED)
    given = stage(_apart(_apart(marked, "one"), "two").select("doc_id", "text", "label"), "labelled")
    held = {r["label"]: r["count"] for r in given.groupBy("label").count().collect()}
    toxic, ordinary = held.get(1, 0), held.get(0, 0)
    if not toxic or not ordinary:
        share = 1 - 1e-9 if toxic else 1e-9
        return Model(b"", b"", (math.log(share / (1 - share)), *[0.0] * (1 + 2 * len(THRESHOLDS))))
    telling = _telling(given, toxic, ordinary, seed_rows)
    usual = _trained(given.filter("label = 0"), Model(telling, b"", ()))
    model = Model(usual + telling, usual, ())
    rows = sorted((r["label"], r["held"]) for r in given.mapInArrow(
        lambda b: _histograms(b, model), "label int, held array<int>").collect())
    y, h = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], np.int64)
    steps = [np.repeat(np.arange(32), own) for own in h]
    text = np.repeat(np.arange(len(h)), h.sum(1))
    x = _evidence(text, np.concatenate(steps) if len(steps) else text, len(h))
    unstage(given)
    return model._replace(weights=tuple(_logistic(x, y).tolist()))


def _apart(given: DataFrame, mark: str) -> DataFrame:
    """One document of each class and mark."""
    names = given.columns
    return given.groupBy("label", mark).agg(
        F.min_by(F.struct(*names), F.struct(F.xxhash64("doc_id"), "doc_id", "text")).alias("row")).select("row.*")


def _class(labels: DataFrame, usable: Column, value: int, rows: int) -> DataFrame:
    """A bounded table: labelled documents of one class, the first by a hash of the id."""
    known = labels.filter(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    one = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")).filter(F.col("label") == value)
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _telling(given: DataFrame, toxic: int, ordinary: int, seed_rows: int) -> bytes:
    """Strings that tell toxic documents from ordinary ones.

    What comes to the driver is bounded by the seed documents: hashes of strings that
    several of them hold, then the bytes of those that tell the classes apart.
    """
    chosen = given.filter("label = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(seed_rows).select("doc_id")
    seeds = given.join(F.broadcast(chosen), "doc_id").select("text")
    frequent = seeds.mapInArrow(_seeds, "part int, held binary").groupBy("part").applyInArrow(
        _frequent, "hash long").toPandas()
    hashes = np.sort(frequent["hash"].to_numpy().astype(np.int64).view(np.uint64))
    share = (F.col("t") + F.col("o")) / (toxic + ordinary)
    z = (F.col("t") / toxic - F.col("o") / ordinary) / F.sqrt(share * (1 - share) * (1 / toxic + 1 / ordinary))
    ratio = (F.col("t") + 0.5) / (toxic + 1) / ((F.col("o") + 0.5) / (ordinary + 1))
    told = given.mapInArrow(lambda b: _counted(b, hashes), "hash long, t long, o long").groupBy("hash").agg(
        F.sum("t").alias("t"), F.sum("o").alias("o")).select("hash", z.alias("z"), ratio.alias("ratio")).filter(
        (F.col("z") >= LEAST_Z) & (F.col("ratio") >= LEAST_RATIO)).collect()
    wanted = np.sort(np.array([r["hash"] for r in told], np.int64).view(np.uint64))
    names = {r["hash"]: bytes(r["string"]) for r in seeds.mapInArrow(
        lambda b: _named(b, wanted), "hash long, string binary").groupBy("hash").agg(
        F.min("string").alias("string")).collect()}
    return _content({names[r["hash"]]: (r["z"], r["ratio"]) for r in told})


def _hard(batches, model: Model):
    """Ordinary windows that toxic strings shorten."""
    out, coders = pa.schema([("window", pa.binary())]), _coders(model)
    for batch in batches:
        for part in slices(batch):
            data, at = _lowered(part)
            _, start, end = windows(data, at)
            _, saving = savings(data, at, coders)
            own = np.flatnonzero(saving >= HARD)
            yield batch_of(out, [b" " + data[s:e].tobytes() + b" " for s, e in zip(start[own], end[own])])


def _trained(ordinary: DataFrame, model: Model) -> bytes:
    """A dictionary that zstandard trains on such windows; the windows themselves where they are too few."""
    held = ordinary.mapInArrow(lambda b: _hard(b, model), "window binary").groupBy("window").count().orderBy(
        F.xxhash64("window"), "window").limit(HARD_ROWS).collect()
    samples = sorted((bytes(r["window"]) for r in held for _ in range(min(r["count"], 8))), key=lambda w: (len(w), w))
    if sum(map(len, samples)) <= SIZE:
        return b"".join(samples)
    try:
        return zstandard.train_dictionary(SIZE, samples, k=SEGMENT, d=GRAM, level=3).as_bytes()
    except zstandard.ZstdError:  # too few or too much alike
        return b"".join(samples)[-SIZE:]


def _content(strings: dict[bytes, tuple[float, float]]) -> bytes:
    """The strings to keep, the most telling ones last, where references are cheapest.

    Taken by significance, the longer first; a string that shares half of its bytes with a
    taken one, within it or over its edge, adds nothing unless it is more telling by far.
    """
    taken: list[bytes] = []
    for string in sorted(strings, key=lambda s: (-round(strings[s][0], 6), -len(s), s)):
        if all(strings[string][1] >= LONGER * strings[t][1] or not _shared(string, t) for t in taken):
            taken.append(string)
    return b" ".join([b"", *taken[::-1], b""])


def _shared(string: bytes, other: bytes) -> bool:
    half = len(string) // 2
    within = any(string[k:k + half + 2] in other for k in range(len(string) - half - 1))
    return within or other in string or any(
        string.endswith(other[:n]) or string.startswith(other[-n:]) for n in range(half, min(len(string), len(other))))


def _scores(batches, model: Model):
    out = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    coders, weights = _coders(model), np.array(model.weights)
    for batch in batches:
        for part in slices(batch):
            text, saving = savings(*_lowered(part), coders)
            x = _evidence(text, saving, part.num_rows)
            margin = (x * weights).sum(1)
            yield batch_of(out, part.column("doc_id"), 1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): the probability that a text is toxic."""
    return docs.select(F.col("doc_id").cast("long"), as_text()).mapInArrow(
        lambda batches: _scores(batches, model), "doc_id long, score double")
