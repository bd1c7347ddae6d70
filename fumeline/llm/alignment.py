"""Links between the tokens of two tokenizers over the same bytes (operator 13).

Both tokenizers cut a space and the text into tokens. Byte offsets at which tokens of
both end cut the tokens into groups, and every token of the one is linked with every
token of the other in its group. How many documents hold a pair of ids linked is counted
over the whole corpus, and each document's links are then weighed by these counts.

Identity-map fast path: one array, from the first tokenizer's ids to the second's id of
the same bytes, tells most links at once. They are counted in arrays of the vocabulary's
length, one per task, and never shuffled as pairs. Only pairs outside the map, from
groups of several tokens, enter the pair shuffle. Their counts are met again without a
hot key: the pairs that hold 1/65,536 of all occurrences or more, of which there are no
more than 65,536, go to the tasks as an array; the others are joined, and none of these
has more than that share of the rows.

Ids of the first tokenizer come from its file's vocabulary and merges. Merging by id gives
the same tokens, several times faster, if every entry is what its own merges make of its
bytes; that is looked at when the files are read, and texts with characters other than
common Latin ones, or runs without a space (or of spaces) of 2,000 characters, take the
slower way in any case, as the two libraries may class rare characters differently.

Cases: null and empty texts, and texts that a tokenizer does not give back byte for byte
(invalid UTF-8 among them), have no tokens: zeros and an empty ``groups_sha256``. Rows
count as documents each by itself, repeated ids and null ids too. Tokens of no bytes do
not occur in either vocabulary's output. A group's pairs are made from its distinct ids,
so a long run of equal tokens costs what its distinct ids do. An empty table gives no
rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.llm.common import batch_of, slices, text_bytes
from fumeline.session import stage, unstage

TOKENIZERS = "/opt/tokenizers"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT = 1 << 16  # pairs whose counts tasks hold at most

# How the first tokenizer cuts text before merging, and its bytes that stand for themselves.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))

_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ–—‘’“”…€]*")
_LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for."""
    own = [b for low, high in PRINTED for b in range(low, high + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Both tokenizers, and their vocabularies as bytes."""

    def __init__(self, merges: str, model: bytes, by_id: bool | None = None):
        import sentencepiece
        import tokenizers

        self.slow = tokenizers.Tokenizer.from_str(merges)
        self.slow.encode_special_tokens = True  # their strings in a text are plain text
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        special = {t["id"] for t in json.loads(merges)["added_tokens"]}
        letters = byte_of()
        entries = {i: bytes(map(letters.__getitem__, s)) for s, i in self.slow.get_vocab().items() if i not in special}
        self.first_bytes = [entries.get(i, b"") for i in range(self.slow.get_vocab_size())]
        self.second_bytes = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            plain = b"" if self.second.is_control(i) or self.second.is_unknown(i) else (
                bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode())
            self.second_bytes.append(plain)
        self.by_id = self._merged_by_id(letters) if by_id is None else by_id
        self.fast = None
        if self.by_id:
            import tiktoken

            self.fast = tiktoken.Encoding(
                "first", pat_str=PATTERN, mergeable_ranks={b: i for i, b in entries.items()}, special_tokens={})

    def _merged_by_id(self, letters: dict[str, int]) -> bool:
        """Whether every entry of the first vocabulary is what its merges make of its own bytes."""
        back = {b: c for c, b in letters.items()}
        return all(
            [t.id for t in self.slow.model.tokenize("".join(back[b] for b in own))] == [i]
            for i, own in enumerate(self.first_bytes) if own)

    def first_ids(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        slow = []
        for k, text in enumerate(texts):
            if self.fast and _PLAIN.fullmatch(text) and not _LONG_RUN.search(text):
                out[k] = self.fast.encode_ordinary(" " + text)
            else:
                slow.append(k)
        for k in slow:
            out[k] = self.slow.encode(" " + texts[k], add_special_tokens=False).ids
        return out

    def second_ids(self, texts: list[str]) -> list[list[int]]:
        return self.second.encode(texts, num_threads=1)

    def same(self) -> np.ndarray:
        """The identity map: the lowest id of the second vocabulary with an id's bytes, or -1."""
        found: dict[bytes, int] = {}
        for i, own in enumerate(self.second_bytes):
            if own:
                found.setdefault(own, i)
        return np.array([found.get(own, -1) if own else -1 for own in self.first_bytes], np.int64)


class _Side:
    """A vocabulary's entries in one array of bytes, and their ids as text."""

    def __init__(self, entries: list[bytes], ends: tuple[bytes, bytes]):
        self.data, at = text_bytes(pa.array(entries, pa.binary()))
        self.starts, self.sizes = at[:-1], np.diff(at)
        # Two texts per id: within its group, and last in it.
        self.names = np.array([b"%d%s" % (i, end) for i in range(len(entries)) for end in ends], object)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.data[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and how many each list has."""
    sizes = np.array([len(x) for x in lists], np.int64)
    return np.fromiter((i for x in lists for i in x), np.int64, int(sizes.sum())), sizes


def _of_rows(sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(sizes)), sizes)


def _given_back(side: _Side, ids: np.ndarray, sizes: np.ndarray, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which rows' tokens join to the row's bytes."""
    row = _of_rows(sizes)
    spelled = np.bincount(row, side.sizes[ids], len(sizes)).astype(np.int64)
    right = (spelled == np.diff(at)) & (sizes > 0)
    both = right[row]
    wanted = data[np.repeat(right, np.diff(at))]
    wrong = np.flatnonzero(side.spelled(ids[both]) != wanted)
    if len(wrong):
        ends = np.cumsum(np.diff(at)[right])
        right[np.flatnonzero(right)[np.searchsorted(ends, wrong, "right")]] = False
    return right


def _expanded(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[k], starts[k] + 1, ... ``counts[k]`` numbers for each k."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of the weights of each (or how many there are)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    run = keys[order]
    heads = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    if weights is None:
        return run[heads], np.diff(np.append(heads, len(run)))
    return run[heads], np.add.reduceat(weights[order], heads)


class Aligned:
    """The groups of several rows' tokens. Rows are those that both tokenizers give back."""

    def __init__(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, first: _Side, second: _Side):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        self.row_a, self.row_b = _of_rows(n_a), _of_rows(n_b)
        ends_a, ends_b = np.cumsum(first.sizes[a]), np.cumsum(second.sizes[b])
        self.last_a = np.isin(ends_a, ends_b, assume_unique=True)
        self.last_b = np.isin(ends_b, ends_a, assume_unique=True)
        self.group_a = np.cumsum(self.last_a) - self.last_a
        self.group_b = np.cumsum(self.last_b) - self.last_b
        self.groups = int(self.last_a.sum())
        self.row = self.row_a[self.last_a]  # of each group
        self.many_a = np.bincount(self.group_a, minlength=self.groups)
        self.many_b = np.bincount(self.group_b, minlength=self.groups)

    def links(self, same: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, pair, times): the distinct pairs of each row, a pair being a * width + b."""
        # Groups of one token each, of the same bytes: the map tells the pair.
        single = (self.many_a == 1) & (self.many_b == 1)
        first_a, first_b = np.cumsum(self.many_a) - self.many_a, np.cumsum(self.many_b) - self.many_b
        mapped = np.zeros(self.groups, bool)
        mapped[single] = same[self.a[first_a[single]]] == self.b[first_b[single]]
        own = self.a[first_a[mapped]]
        rows, pairs = [self.row[mapped]], [own * width + same[own]]
        times = [np.ones(len(own), np.int64)]
        # The others: distinct ids of a group on both sides.
        rest_a, rest_b = ~mapped[self.group_a], ~mapped[self.group_b]
        of_a, held_a = _counted(self.group_a[rest_a] * (1 << 31) + self.a[rest_a])
        of_b, held_b = _counted(self.group_b[rest_b] * (1 << 31) + self.b[rest_b])
        group = of_a >> 31
        low, high = np.searchsorted(of_b >> 31, group), np.searchsorted(of_b >> 31, group, "right")
        at = _expanded(low, high - low)
        left = np.repeat(np.arange(len(group)), high - low)
        mask = (1 << 31) - 1
        rows.append(self.row[group[left]])
        pairs.append((of_a[left] & mask) * width + (of_b[at] & mask))
        times.append(held_a[left] * held_b[at])
        row, pair, times = map(np.concatenate, (rows, pairs, times))
        order = np.argsort(pair, kind="stable")
        order = order[np.argsort(row[order], kind="stable")]
        row, pair, times = row[order], pair[order], times[order]
        heads = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (pair[1:] != pair[:-1]))) if len(row) else order
        return row[heads], pair[heads], np.add.reduceat(times, heads) if len(heads) else times

    def digests(self, first: _Side, second: _Side) -> list[str]:
        """Each row's groups as text, hashed."""
        before_a, before_b = np.cumsum(self.many_a), np.cumsum(self.many_b) - self.many_b
        words = np.empty(len(self.a) + len(self.b), object)
        words[np.arange(len(self.a)) + before_b[self.group_a]] = first.names[self.a * 2 + self.last_a]
        words[np.arange(len(self.b)) + before_a[self.group_b]] = second.names[self.b * 2 + self.last_b]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [hashlib.sha256(b"".join(words[s:e].tolist())[:-1]).hexdigest() for s, e in zip([0, *ends], ends)]


_ALIGNED = pa.schema([
    ("doc_id", pa.int64()), ("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("own", pa.list_(pa.int32())),
    ("own_times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
_ALIGNED_DDL = ("doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                "own array<int>, own_times array<int>, pairs array<long>, times array<long>")


def _lists(row: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    at = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


def _texts(column: pa.Array) -> list[str]:
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [x.as_buffer().to_pybytes().decode(errors="replace") for x in column]


def _align(batches, merges: str, model: bytes, by_id: bool):
    pair, first, second, same = None, None, None, None
    for batch in batches:
        if pair is None:
            pair = Pair(merges, model, by_id)
            first, second = _Side(pair.first_bytes, (b",", b"|")), _Side(pair.second_bytes, (b",", b";"))
            same, width = pair.same(), len(pair.second_bytes)
        for part in slices(batch):
            n = part.num_rows
            texts = _texts(part.column("text"))
            held = np.array([k for k, t in enumerate(texts) if t], np.int64)
            data, at = text_bytes(part.column("text"))
            a, n_a = _flat(pair.first_ids([texts[k] for k in held]))
            b, n_b = _flat(pair.second_ids([texts[k] for k in held]))
            # A space before each text.
            whole = np.insert(data, at[held], 0x20) if len(held) else data
            whole_at = np.append(0, np.cumsum(np.diff(at)[held] + 1))
            right = _given_back(first, a, n_a, whole, whole_at) & _given_back(second, b, n_b, whole, whole_at)
            rows = held[right]
            found = Aligned(a[np.repeat(right, n_a)], n_a[right], b[np.repeat(right, n_b)], n_b[right], first, second)
            row, pairs, times = found.links(same, width)
            is_own = same[pairs // width] == pairs % width
            counts = np.zeros((4, n), np.int64)
            counts[0, rows], counts[1, rows] = found.n_a, found.n_b
            counts[2, rows] = np.bincount(found.row, minlength=len(rows))
            counts[3] = np.bincount(rows[found.row], found.many_a * found.many_b, n)
            digests = np.full(n, "", object)
            digests[rows] = found.digests(first, second)
            at_row = rows[row]
            yield batch_of(
                _ALIGNED, part.column("doc_id"), part.column("row"), *counts, digests.tolist(),
                _lists(at_row[is_own], pairs[is_own] // width, n, pa.int32()),
                _lists(at_row[is_own], times[is_own], n, pa.int32()),
                _lists(at_row[~is_own], pairs[~is_own], n, pa.int64()), _lists(at_row[~is_own], times[~is_own], n, pa.int64()))


def _own_counts(batches, size: int):
    """How many rows of a task hold each id linked by the map: one array of the vocabulary's length."""
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(batch.column("own").flatten().to_numpy(), minlength=size)
    ids = np.flatnonzero(total)
    yield batch_of(pa.schema([("id", pa.int64()), ("n", pa.int64())]), ids, total[ids])


_WEIGHED = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _sums(column: pa.Array, values: np.ndarray) -> np.ndarray:
    """The sum over each list's stretch of ``values``."""
    at = column.offsets.to_numpy().astype(np.int64)
    total = np.append(0, np.cumsum(values))
    at = at - at[0]
    return total[at[1:]] - total[at[:-1]]


def _weigh(batches, own: np.ndarray, best: np.ndarray, hot: np.ndarray, hot_n: np.ndarray, width: int):
    """Each row's sums over the links of known counts, and its other pairs."""
    out = pa.schema([*list(_ALIGNED)[:7], ("n_best", pa.int64()), ("count_sum", pa.int64()),
                     ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])
    for batch in batches:
        ids = batch.column("own").flatten().to_numpy()
        times = batch.column("own_times").flatten().to_numpy().astype(np.int64)
        n_best = _sums(batch.column("own"), times * (own[ids] == best[ids]))
        total = _sums(batch.column("own"), times * own[ids])
        pairs, times = batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy()
        at = np.minimum(np.searchsorted(hot, pairs), max(len(hot) - 1, 0))
        known = hot[at] == pairs if len(hot) else np.zeros(len(pairs), bool)
        counts = np.where(known, hot_n[at], 0) if len(hot) else np.zeros(len(pairs), np.int64)
        n_best += _sums(batch.column("pairs"), times * (known & (counts == best[pairs // width])))
        total += _sums(batch.column("pairs"), times * counts)
        offsets = batch.column("pairs").offsets.to_numpy()
        row = _of_rows(np.diff(offsets))[~known]
        yield batch_of(out, *batch.columns[:7], n_best, total, _lists(row, pairs[~known], batch.num_rows, pa.int64()),
                       _lists(row, times[~known], batch.num_rows, pa.int64()))


def _vector(rows, size: int) -> np.ndarray:
    """An array of the vocabulary's length from (id, n) rows, of which there is one per id at most."""
    out = np.zeros(size, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return out


def read_pair(folder: str = TOKENIZERS) -> tuple[str, bytes, Pair]:
    """The two tokenizers' files, read on the driver; tasks get their content."""
    with open(f"{folder}/{FIRST}", encoding="utf-8") as file:
        merges = file.read()
    with open(f"{folder}/{SECOND}", "rb") as file:
        model = file.read()
    return merges, model, Pair(merges, model)


def linked(docs: DataFrame, folder: str = TOKENIZERS, hot: int = HOT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per document.

    ``n_best`` counts the links whose pair is in as many documents as any pair of its
    first id, and ``count_sum`` sums over the links how many documents hold their pair.
    """
    merges, model, pair = read_pair(folder)
    size, width, by_id = len(pair.first_bytes), len(pair.second_bytes), pair.by_id
    read = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    rows = stage(read.mapInArrow(lambda b: _align(b, merges, model, by_id), _ALIGNED_DDL), "aligned")
    own = _vector(rows.select("own").mapInArrow(lambda b: _own_counts(b, size), "id long, n long")
                  .groupBy("id").agg(F.sum("n").alias("n")).toArrow(), size)
    counts = stage(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("n")), "counts")
    first_id = F.expr(f"pair div {width}")
    best = np.maximum(own, _vector(
        counts.groupBy(first_id.alias("id")).agg(F.max("n").alias("n")).toArrow(), size))
    share = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] / hot
    often = counts.filter(F.col("n") > share).orderBy("pair").toArrow()
    often, often_n = (often.column(k).to_numpy() for k in range(2))
    weighed = stage(rows.mapInArrow(
        lambda b: _weigh(b, own, best, often, often_n, width),
        f"{_WEIGHED}, n_best long, count_sum long, pairs array<long>, times array<long>"), "weighed")
    # A row per id of the first vocabulary.
    tops = stage(counts.sparkSession.createDataFrame(
        pa.table({"id": np.arange(size), "top": best})), "tops")
    rare = counts.filter(F.col("n") <= share).withColumn("id", first_id).join(F.broadcast(tops), "id").select(
        "pair", "n", (F.col("n") == F.col("top")).cast("long").alias("is_best"))
    more = weighed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")).join(rare, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("is_best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    unstage(rows)
    return weighed.drop("pairs", "times").join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
