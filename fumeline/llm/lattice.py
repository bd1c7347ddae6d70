"""Language-model scores by a subword lattice (operator 7).

A word is a lattice: its arcs are the pieces of an existing subword vocabulary, and one
arc over the whole word. The forward recursion, in log space, sums over all
segmentations. As no piece reaches over a word's start, a text's marginal probability is
the product of its words' and of its end's.

The vocabulary is never changed. Its scores weigh the segmentations of all distinct
words of the training texts; how often a piece is then expected (forward and backward
recursion) is added to the scores, as to a prior, and gives the weights that texts are
scored with. The whole-word arc has the weight c / (N + a), pieces together a / (N + a),
where c counts the word in the training texts, N all their tokens, and a, the number of
words seen once, is the usual estimate of how often a new word comes.

Texts are coded once: each chunk of text becomes arrays of word numbers and a table of
its distinct words. Counts, lattices and joins then work on distinct words.

Cases: a null or empty text has one token, its end. Bytes outside the vocabulary take
its byte pieces, so every word has a segmentation. With no training text the pieces
alone decide. Repeated documents are scored, and counted in training, each by itself. A
null id counts as training. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import copy
import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fumeline.llm.common import Rolling, _powers, as_text, batch_of, byte_values, mix, slices, text_bytes
from fumeline.session import free, stage, unstage

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 16 << 20
END_SHARE = 1e-3  # of what words not seen share: the end's part
PRIOR = 10_000  # pieces that the vocabulary's own scores count as
ROUNDS = 2  # of expectation and reweighing
_LONG = 48  # bytes; longer words go one by one


class Pieces:
    """A vocabulary as sorted hashes of byte strings with natural log weights that sum to one."""

    def __init__(self, weights: dict[bytes, float]):
        strings = list(weights)
        data, at = text_bytes(pa.array(strings, pa.binary()))
        hashes = Rolling(byte_values()[data]).of(at[:-1], at[1:])
        order = np.argsort(hashes)
        values = np.array([weights[s] for s in strings])
        self.hashes, self.logs = hashes[order], np.log(values / values.sum())[order]
        self.longest = int(np.diff(at).max())
        # Most stretches are no piece; a table of 2^20 marks tells them at once.
        self.marks = np.zeros(1 << 20, bool)
        self.marks[hashes & np.uint64((1 << 20) - 1)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces, and which."""
        maybe = np.flatnonzero(self.marks[hashes & np.uint64((1 << 20) - 1)])
        at = np.searchsorted(self.hashes, hashes[maybe])
        at[at == len(self.hashes)] = 0
        known = self.hashes[at] == hashes[maybe]
        return maybe[known], at[known]

    def reweighed(self, expected: np.ndarray) -> Pieces:
        """The same pieces, their weights the prior's with ``expected`` counts added."""
        out = copy.copy(self)
        out.logs = np.log((np.exp(self.logs) * PRIOR + expected) / (PRIOR + expected.sum()))
        return out


def pieces(path: str = VOCABULARY) -> Pieces:
    """The pieces of a sentencepiece model; a word's first piece begins with a space.

    Scores that are all whole numbers are merge ranks and weigh as 1 / (rank + 2.7);
    others are log probabilities. Each byte piece weighs as its score says.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_unknown(i)]
    normal = [model.get_score(i) for i in ids if not model.is_byte(i)]
    ranks = all(s == int(s) for s in normal)
    weights: dict[bytes, float] = {}
    for i in ids:
        piece, score = model.id_to_piece(i), model.get_score(i)
        if model.is_byte(i):
            text = bytes([int(re.fullmatch(r"<0x(..)>", piece)[1], 16)])
            weight = 1 / (len(ids) + 2.7) if ranks else math.exp(score)
        else:
            text = piece.replace("▁", " ").encode()
            if b" " in text[1:]:
                continue
            weight = 1 / (2.7 - score) if ranks else math.exp(score)
        weights[text] = weights.get(text, 0.0) + weight
    return Pieces(weights)


def marginal(words: list[bytes], table: Pieces, expected: np.ndarray | None = None) -> np.ndarray:
    """The natural log of the summed weight of all segmentations, per word.

    ``expected``, if given, gets how often each piece is expected in the words.
    """
    out = np.empty(len(words))
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        if size > _LONG:
            out[own] = [_long(words[k], table, expected) for k in own.tolist()]
            continue
        for at in range(0, len(own), 20_000):
            some = own[at:at + 20_000]
            grid = np.frombuffer(b"".join(b" " + words[k] for k in some.tolist()), np.uint8).reshape(len(some), size + 1)
            out[some] = _grid(grid, table, expected)
    return out


def _grid(grid: np.ndarray, table: Pieces, expected: np.ndarray | None) -> np.ndarray:
    """Words of one length at a time: the recursions, column by column."""
    n = grid.shape[1]
    up, down = _powers(0, n + 1)
    sums = np.zeros((n + 1, len(grid)), np.uint64)
    np.cumsum(byte_values()[grid.T] * up[:n, None], axis=0, out=sums[1:])
    ahead = np.full((n + 1, len(grid)), -np.inf)
    ahead[0] = 0.0
    arcs = []
    for end in range(1, n + 1):
        for start in range(max(0, end - table.longest), end):
            known, piece = table.find(mix((sums[end] - sums[start]) * down[start]))
            if len(known):
                ahead[end, known] = np.logaddexp(ahead[end, known], ahead[start, known] + table.logs[piece])
                arcs.append((start, end, known, piece))
    if expected is not None:
        behind = np.full((n + 1, len(grid)), -np.inf)
        behind[n] = -ahead[n]
        for start, end, known, piece in sorted(arcs, key=lambda a: -a[0]):
            onward = behind[end, known] + table.logs[piece]
            behind[start, known] = np.logaddexp(behind[start, known], onward)
            np.add.at(expected, piece, np.exp(ahead[start, known] + onward))
    return ahead[n]


def _long(word: bytes, table: Pieces, expected: np.ndarray | None = None) -> float:
    """One word of any length: all arcs at once, then the recursions over them."""
    data = np.frombuffer(b" " + word, np.uint8)
    roll = Rolling(byte_values()[data])
    ends, starts, pieces_ = [], [], []
    for size in range(1, min(table.longest, len(data)) + 1):
        known, piece = table.find(roll.windows(size))
        starts.append(known)
        ends.append(known + size)
        pieces_.append(piece)
    start, end, piece = np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces_)
    order = np.argsort(end, kind="stable")
    start, end, piece = start[order], end[order], piece[order]
    logs = table.logs[piece]
    ahead = _summed(start.tolist(), end.tolist(), logs.tolist(), len(data))
    if expected is not None:
        # Backward is forward on the reversed lattice.
        order = np.argsort(-start, kind="stable")
        behind = np.array(_summed((len(data) - end[order]).tolist(), (len(data) - start[order]).tolist(),
                                  logs[order].tolist(), len(data)))[::-1]
        np.add.at(expected, piece, np.exp(np.array(ahead)[start] + logs + behind[end] - ahead[-1]))
    return ahead[-1]


def _summed(starts: list, ends: list, logs: list, size: int) -> list[float]:
    """Per place, the log of the summed weight of all ways there; arcs come by their ends."""
    ahead = [-math.inf] * (size + 1)
    ahead[0] = 0.0
    for s, e, w in zip(starts, ends, logs):
        x, y = ahead[e], ahead[s] + w
        if x < y:
            x, y = y, x
        if x > -math.inf:
            ahead[e] = x + math.log1p(math.exp(y - x))
    return ahead


_SCALE = 1 << 20  # expected counts are summed as whole numbers, so that their order does not show


def _expected(batches, table: Pieces):
    expected = np.zeros(len(table.hashes))
    for batch in batches:
        marginal([w.as_buffer().to_pybytes() for w in batch.column("word")], table, expected)
    held = np.flatnonzero(expected)
    out = pa.schema([("piece", pa.int32()), ("n", pa.int64())])
    yield batch_of(out, held.astype(np.int32), np.rint(expected[held] * _SCALE).astype(np.int64))


def trained(words: DataFrame, table: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Weights learned from distinct ``words`` (a column ``word``), each counting once."""
    now = table
    for _ in range(rounds):
        counts = words.select("word").mapInArrow(
            lambda batches, now=now: _expected(batches, now), "piece int, n long",
        ).groupBy("piece").agg(F.sum("n").alias("n")).collect()  # a row per piece
        expected = np.zeros(len(table.hashes))
        for r in counts:
            expected[r["piece"]] = r["n"] / _SCALE
        now = table.reweighed(expected)
    return now


class _Coder(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


_CODED = "chunk string, word string, code int, n_train long, doc_id long, train boolean, codes binary"


def _coded(batches):
    out = pa.schema([("chunk", pa.string()), ("word", pa.string()), ("code", pa.int32()), ("n_train", pa.int64()),
                     ("doc_id", pa.int64()), ("train", pa.bool_()), ("codes", pa.binary())])
    for batch in batches:
        for part in slices(batch, most=CHUNK):
            chunk, coder = uuid.uuid4().hex, _Coder()
            train = part.column("train").to_pylist()
            counts = np.zeros(0, np.int64)
            codes = []
            for k, text in enumerate(part.column("text")):
                words = text.as_buffer().to_pybytes().lower().split()
                own = np.fromiter(map(coder.__getitem__, words), np.int32, len(words))
                codes.append(own.tobytes())
                if train[k]:
                    if len(coder) > len(counts):
                        counts = np.append(counts, np.zeros(len(coder), np.int64))
                    if len(own) > 1000:
                        counts += np.bincount(own, minlength=len(counts))
                    else:
                        np.add.at(counts, own, 1)
            counts = np.append(counts, np.zeros(len(coder), np.int64))[:len(coder)]
            n, m = part.num_rows, len(coder)
            yield batch_of(out, [chunk] * n, [None] * n, [None] * n, [None] * n, part.column("doc_id"), train, codes)
            words = pa.array(list(coder), pa.binary()).cast(pa.string())
            for at in range(0, m, 50_000):
                some = min(50_000, m - at)
                none = [None] * some
                yield batch_of(out, [chunk] * some, words.slice(at, some), np.arange(at, at + some, dtype=np.int32),
                               counts[at:at + some], none, none, none)


def _weighed(batches, table: Pieces):
    out = pa.schema([("word", pa.string()), ("c", pa.int64()), ("q", pa.float64())])
    for batch in batches:
        words = [w.as_buffer().to_pybytes() for w in batch.column("word")]
        yield batch_of(out, batch.column("word"), batch.column("c"), marginal(words, table))


_SCORED = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("base_score", pa.float64()), ("score", pa.float64())])


def _scored(docs: pa.Table, words: pa.Table, total: dict) -> pa.Table:
    """A chunk's texts: sums over their words' scores."""
    size = words.num_rows
    code = words.column("code").to_numpy()
    c, q = np.zeros(size), np.zeros(size)
    c[code], q[code] = words.column("c").to_numpy(), words.column("q").to_numpy()
    n, seen, a, ends = total["n"], total["v"], total["a"], total["ends"]
    rest = n + 0.5 * (seen + 1)
    base = np.log10((c + 0.5) / rest)
    # log(c + a q) without losing small q.
    with np.errstate(divide="ignore"):
        own = np.logaddexp(np.log(c), math.log(a * (1 - END_SHARE)) + q) / math.log(10) - math.log10(n + a)
    end_base, end_own = math.log10((ends + 0.5) / rest), math.log10((ends + a * END_SHARE) / (n + a))
    known = c > 0
    rows = []
    for codes in docs.column("codes").to_pylist():
        at = np.frombuffer(codes, np.int32)
        rows.append((len(at) + 1, int(known[at].sum()) + (ends > 0), float(base[at].sum()) + end_base,
                     float(own[at].sum()) + end_own))
    columns = map(list, zip(*rows)) if rows else [[]] * 4
    return pa.Table.from_batches([batch_of(
        _SCORED, docs.column("doc_id").combine_chunks(), docs.column("train").combine_chunks(), *columns)])


def scores(docs: DataFrame, train: Column, path: str = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) for every document."""
    table = pieces(path)
    read = docs.select(F.col("doc_id").cast("long"), as_text(), F.coalesce(train, F.lit(True)).alias("train"))
    coded = stage(read.mapInArrow(_coded, _CODED), "coded")
    words = coded.filter(F.col("word").isNotNull()).select(F.col("chunk").alias("of"), "word", "code", "n_train")
    texts = coded.filter(F.col("codes").isNotNull()).select("chunk", "doc_id", "train", "codes")
    counted = stage(words.groupBy("word").agg(F.sum("n_train").alias("c")), "counted")
    free(docs.sparkSession)
    table = trained(counted.filter(F.col("c") > 0), table, rounds)
    vocabulary = stage(counted.mapInArrow(
        lambda batches: _weighed(batches, table), "word string, c long, q double"), "vocabulary")
    unstage(counted)
    count = vocabulary.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v"),
        F.count(F.when(F.col("c") == 1, 1)).alias("once")).first()
    ends = texts.filter("train").count()
    total = {"n": count["n"] + ends, "v": count["v"] + (ends > 0), "a": max(1, count["once"]), "ends": ends}
    joined = words.join(vocabulary, "word").select("of", "code", "c", "q")
    found = texts.groupBy("chunk").cogroup(joined.groupBy("of")).applyInArrow(
        lambda d, w: _scored(d, w, total),
        "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return found.withColumn("train_tokens", F.lit(total["n"]).cast("long"))
