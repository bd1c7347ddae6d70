"""Benchmark decontamination with an FM-index per training shard (operator 10).

The words of the benchmark items, lower-cased, are the alphabet; every other word of a
text, and the gap between texts, is one separator, and separators in a row are one. A
shard is a stretch of some hundred thousand symbols of the documents a task reads. Its
suffix array gives the Burrows-Wheeler transform, which is kept as a wavelet matrix
with running counts. All windows of the items are searched backwards at the same time,
their places are found by walking to sampled suffix positions, and the words they
cover are merged to spans.

Items go to the tasks in passes of a fixed number of bytes, so what a task holds does
not grow with the benchmark.

Cases: a null text or item has no words. An item with fewer than ten words is one
window; one without words is never found. Repeated items each count; repeated rows of
one item id are one item with the windows of all. Items without an id are searched too and
their words count as hit; all of them together add one to ``n_items``, last in ``items``, and
nothing to ``items_sha256``. Documents of any length are cut into
shards that overlap by a window less a word, so no place is lost. Item ids are compared
as text. Columns other than ``doc_id``, ``text`` and ``item_id`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.llm.common import (
    as_text, batch_of, delimiters, slices, text_bytes, word_bounds, word_hashes,
)

WINDOW = 10
PASS_BYTES = 16 << 20  # bytes of items searched for in one pass
SHARD = 1 << 19  # symbols of a shard
SAMPLE = 16  # every so many suffix positions are kept
# Bytes that part words: all of ASCII but digits and lower-case letters, after lower-casing.
PARTS = ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_BITS = 21  # a shard's positions and ranks are below 2^21


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


class Phrases:
    """Distinct windows of some items: by length, as rows of symbols; and the items of each."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        texts = pa.array([t for _, t in items], pa.string())
        data, at = text_bytes(texts)
        data = _lower()[data]
        starts, ends, first = word_bounds(data, at, delimiters(*PARTS))
        hashes = word_hashes(data, starts, ends)
        self.vocabulary = np.unique(hashes)
        codes = np.searchsorted(self.vocabulary, hashes) + 1
        found: dict[tuple, list[int]] = {}
        for k in range(len(items)):
            own = codes[first[k]:first[k + 1]]
            width = min(window, len(own))
            for i in range(len(own) - width + 1 if width else 0):
                found.setdefault(tuple(own[i:i + width].tolist()), []).append(k)
        self.ids = [i for i, _ in items]
        rows = sorted(found, key=lambda w: (len(w), w))
        self.widths = np.array([len(w) for w in rows], np.int64)
        self.rows = {n: np.array([w for w in rows if len(w) == n], np.int64) for n in set(map(len, rows))}
        owners = [sorted(set(found[w])) for w in rows]
        self.owner_first = np.append(0, np.cumsum([len(o) for o in owners])).astype(np.int64)
        self.owners = np.array([k for o in owners for k in o], np.int64)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by prefix doubling; a suffix of another comes first.

    Each round sorts only the suffixes that are not yet told apart.
    """
    n = len(symbols)
    shift, low = np.uint64(_BITS), np.uint64((1 << _BITS) - 1)
    index = np.arange(n, dtype=np.uint64)
    packed = np.sort(symbols.astype(np.uint64) << shift | index)
    order = (packed & low).astype(np.int64)
    key = packed >> shift
    fresh = np.ones(n, bool)
    fresh[1:] = key[1:] != key[:-1]
    rank = np.zeros(2 * n + 1, np.int64)  # past the end: 0, before every real rank
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) + 1
    single = fresh & np.append(fresh[1:], True)
    open_ = np.sort(order[~single])
    reach = 1
    while len(open_):
        packed = np.sort((rank[open_].astype(np.uint64) << shift | rank[open_ + min(reach, n)].astype(np.uint64))
                         << shift | open_.astype(np.uint64))
        at = (packed & low).astype(np.int64)
        pair = packed >> shift
        old = pair >> shift
        begins = np.ones(len(at), bool)
        begins[1:] = old[1:] != old[:-1]
        fresh = np.ones(len(at), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        place = np.arange(len(at))
        group = np.maximum.accumulate(np.where(begins, place, 0))
        part = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[at] = old.astype(np.int64) + part - group
        single = fresh & np.append(fresh[1:], True)
        open_ = np.sort(at[~single])
        reach *= 2
    order = np.empty(n, np.int64)
    order[rank[:n] - 1] = np.arange(n)
    return order


class Wavelet:
    """Symbols as a wavelet matrix: the bits of each level, top bit first, with running counts."""

    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max()).bit_length())
        self.counts, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            counts = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=counts[1:], dtype=np.int32)
            self.counts.append(counts)
            self.zeros.append(len(symbols) - int(counts[-1]))
            set_ = bit.astype(bool)
            symbols = np.concatenate([symbols[~set_], symbols[set_]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``at``."""
        start = np.zeros(len(at), np.int64)
        for level, (counts, zeros) in enumerate(zip(self.counts, self.zeros)):
            one = (symbol >> (self.bits - 1 - level)) & 1
            a, s = counts[at], counts[start]
            at, start = np.where(one, zeros + a, at - a), np.where(one, zeros + s, start - s)
        return at - start

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``at`` and how often it occurs before."""
        symbol, start, place = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), at
        for counts, zeros in zip(self.counts, self.zeros):
            one = counts[place + 1] - counts[place]
            symbol = symbol * 2 + one
            a, s = counts[place], counts[start]
            place, start = np.where(one, zeros + a, place - a), np.where(one, zeros + s, start - s)
        return symbol, place - start


class FmIndex:
    """Backward search over one shard. Symbol 0 parts texts; an end mark below it is added."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        symbols = np.append(symbols + 1, 0)
        order = suffix_array(symbols)
        self.wavelet = Wavelet(symbols[order - 1])
        self.before = np.append(0, np.cumsum(np.bincount(symbols, minlength=int(symbols.max()) + 1)))
        self.size = len(symbols)
        marked = order % sample == 0
        self.mark_count = np.append(0, np.cumsum(marked)).astype(np.int32)
        self.marked = order[marked].astype(np.int32)

    def search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes [low, high) that begin with each row of symbols."""
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), self.size, np.int64)
        rows, top = rows + 1, len(self.before) - 1
        live = np.arange(len(rows))
        for column in range(rows.shape[1] - 1, -1, -1):
            symbol = rows[live, column]
            known = symbol < top
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.before[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.wavelet.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        return low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """The text positions of suffixes: walk back to a sampled one and count the steps."""
        found = np.empty(len(at), np.int64)
        live, steps = np.arange(len(at)), 0
        while len(live):
            known = self.mark_count[at + 1] > self.mark_count[at]
            found[live[known]] = self.marked[self.mark_count[at[known]]] + steps
            live, at = live[~known], at[~known]
            symbol, rank = self.wavelet.symbol_and_rank(at)
            at = self.before[symbol] + rank
            steps += 1
        return found


def occurrences(symbols: np.ndarray, phrases: Phrases, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """(window, position): every place of every window in a sequence of symbols."""
    longest = max(phrases.rows, default=1)
    windows, places = [], []
    for at in range(0, len(symbols), shard):
        part = symbols[at:at + shard + longest - 1]
        if not part.any():
            continue
        index, base = FmIndex(part), 0
        for width in sorted(phrases.rows):
            rows = phrases.rows[width]
            low, high = index.search(rows)
            n = np.maximum(high - low, 0)
            which = np.repeat(np.arange(len(rows)), n)
            suffix = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            windows.append(which + base)
            places.append(index.locate(suffix) + at)
            base += len(rows)
    if not windows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(windows), np.concatenate(places)


_SPANS = "spans array<struct<start:int,end:int>>"  # bytes of the text
_EXTRA = f"n_words long, n_hit long, {_SPANS}, items array<string>"


def _runs(hit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each run of hit words; runs end with their text."""
    if not len(hit):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens, shuts = hit.copy(), hit.copy()
    inner = first[(first > 0) & (first < len(hit))]
    opens[1:] &= ~hit[:-1]
    opens[inner] = hit[inner]
    shuts[:-1] &= ~hit[1:]
    shuts[inner - 1] = hit[inner - 1]
    return np.flatnonzero(opens), np.flatnonzero(shuts)


def _nulls_last(item: str | None) -> tuple[bool, str]:
    return item is None, item or ""


def _find(batches, items: list[tuple[str | None, str]], window: int, schema: pa.Schema):
    phrases, lower, inside = Phrases(items, window), _lower(), delimiters(*PARTS)
    for batch in batches:
        for part in slices(batch):
            data, at = text_bytes(part.column("text"))
            data = lower[data]
            starts, ends, first = word_bounds(data, at, inside)
            hashes = word_hashes(data, starts, ends)
            hit = np.zeros(len(starts) + 1, np.int64)
            owners = np.zeros(0, np.int64)
            docs = np.zeros(0, np.int64)
            if len(phrases.vocabulary):
                code = np.searchsorted(phrases.vocabulary, hashes)
                code[code == len(phrases.vocabulary)] = 0
                known = phrases.vocabulary[code] == hashes
                # A separator takes the place of each unknown word, and goes before each text.
                code = np.where(known, code + 1, 0)
                word = np.arange(len(code))
                opens = np.zeros(len(code), np.int64)
                inner = first[:-1][first[:-1] < len(code)]
                opens[inner] = 1
                place = word + np.cumsum(opens)
                symbols = np.zeros(len(code) + int(opens.sum()) + 1, np.int64)
                source = np.zeros(len(symbols), np.int64)
                symbols[place], source[place] = code, word
                keep = symbols > 0
                keep[1:] |= symbols[:-1] > 0
                symbols, source = symbols[keep], source[keep]
                which, where = occurrences(symbols, phrases)
                begin = source[where]
                np.add.at(hit, begin, 1)
                np.add.at(hit, begin + phrases.widths[which], -1)
                doc = np.searchsorted(first, begin, "right") - 1
                n = np.diff(phrases.owner_first)[which]
                owner = np.repeat(phrases.owner_first[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pairs = np.unique(np.repeat(doc, n) * len(items) + phrases.owners[owner])
                docs, owners = np.divmod(pairs, max(1, len(items)))
            hit = np.cumsum(hit)[:-1] > 0
            a, b = _runs(hit, first)
            run_doc = np.searchsorted(first, a, "right") - 1
            spans: list[list] = [[] for _ in range(part.num_rows)]
            for d, s, e in zip(run_doc.tolist(), starts[a].tolist(), ends[b].tolist()):
                spans[d].append({"start": s - int(at[d]), "end": e - int(at[d])})
            found: list[list] = [[] for _ in range(part.num_rows)]
            for d, k in zip(docs.tolist(), owners.tolist()):
                found[d].append(phrases.ids[k])
            sums = np.append(0, np.cumsum(hit))
            columns = {"n_words": np.diff(first), "n_hit": sums[first[1:]] - sums[first[:-1]],
                       "spans": spans, "items": [sorted(set(i), key=_nulls_last) for i in found]}
            if "spans" in part.schema.names:  # of an earlier pass
                for k in range(part.num_rows):
                    old = part.column("spans")[k].as_py()
                    if old:
                        columns["spans"][k], columns["n_hit"][k] = _merged(
                            columns["spans"][k] + old, data, at[k], starts[first[k]:first[k + 1]])
                    columns["items"][k] = sorted(
                        {*columns["items"][k], *part.column("items")[k].as_py()}, key=_nulls_last)
            yield batch_of(schema, *[
                columns[f.name] if f.name in columns else part.column(f.name) for f in schema])


def _merged(spans: list[dict], data: np.ndarray, base: int, starts: np.ndarray) -> tuple[list[dict], int]:
    """Spans of several passes as one list, and the number of words that they cover."""
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
        # Spans join when no whole word lies between them.
        if out and not ((starts - base >= out[-1]["end"]) & (starts - base < span["start"])).any():
            out[-1]["end"] = max(out[-1]["end"], span["end"])
        else:
            out.append(dict(span))
    hit = sum(int(((starts - base >= s["start"]) & (starts - base < s["end"])).sum()) for s in out)
    return out, hit


def _cut(batches, mask: str):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for k, spans in enumerate(batch.column("spans").to_pylist()):
            if spans:
                data, out, at = texts[k].encode(), [], 0
                for span in spans:
                    out.append(data[at:span["start"]])
                    at = span["end"]
                texts[k] = mask.encode().join([*out, data[at:]]).decode()
        names = [n for n in batch.schema.names if n != "spans"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names=names)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, spans (byte ranges to remove, merged) and items (found item ids).

    Reads all columns of ``docs``; those named like the added ones are replaced.
    """
    added = ("n_words", "n_hit", "spans", "items")
    df = docs.drop(*added).withColumn("text", as_text())
    named = benchmark.select(F.col("item_id").cast("string").alias("item_id"), as_text()).groupBy(
        "item_id", "text").agg(F.lit(1))
    size = F.octet_length("text").cast("long") + 64
    total = named.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    passes = max(1, -(-int(total) * 5 // (4 * pass_bytes)))
    for k in range(passes):
        own = named.filter(F.pmod(F.xxhash64(F.coalesce("item_id", "text")), F.lit(passes)) == k)
        items = sorted(((r["item_id"], r["text"]) for r in own.collect()), key=lambda i: (_nulls_last(i[0]), i[1]))  # about pass_bytes at most
        shape = df.drop(*added)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape.schema)
        whole = f"{fields}, {_EXTRA}"
        schema = _arrow(df.sparkSession, whole)
        df = df.mapInArrow(
            lambda batches, items=items, schema=schema: _find(batches, items, window, schema), whole)
    return df


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, mask: str = " ") -> DataFrame:
    """The documents with every span that occurs in the benchmark cut out, in their own columns."""
    # Under plain names while columns are added, as documents may have columns named like those.
    plain = docs.toDF(*[n if n == "text" else f"c{k}" for k, n in enumerate(docs.columns)])
    found = contamination(plain, benchmark, window)
    return found.select(*plain.columns, "spans").mapInArrow(
        lambda batches: _cut(batches, mask), plain.schema).toDF(*docs.columns)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every document."""
    found = contamination(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, window)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
