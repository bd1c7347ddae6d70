"""SimHash near-duplicates by bit-sliced comparison (operator 4).

Fingerprints are grouped by what they share: of eight bytes, two that differ in at most
two bits agree in six, so every such pair meets under one of 28 choices of six bytes.
A group holds distinct fingerprints that share 48 bits, 65,536 at most whatever the
input. Within a group the fingerprints are stored as bit planes, 64 fingerprints to a
word; distances of a word grow in two bitwise counters with carry-save adds, plane by
plane, and a word is dropped once all its distances exceed the radius.

Cases: a null text, or one without words, has the fingerprint zero and is linked like
any other. Texts with fewer than three words have one shingle, the whole sequence.
Repeated documents share a fingerprint and so a component; a null id is never the
smallest of its component. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.llm.common import as_text, batch_of, fresh
from fumeline.llm.components import components
from fumeline.session import stage

RADIUS = 2
SHINGLE = 3
SEED = 42
_JOBS = 1 << 16  # words compared at once
_SIGN = np.array([-(1 << 63)], np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is in over half of the shingles' hashes."""
    words = text.lower().split()  # bytes: only A-Z change, only 0x20 and 0x09-0x0D part words
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends - sizes + 1)[:len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist())]
    ones, values = np.zeros(64, np.int64), np.array(hashes, "<u8")
    for at in range(0, len(values), 8192):
        bits = np.unpackbits(values[at:at + 8192].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0])


def _prints(batches, shingle: int):
    out = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    for batch in batches:
        found = [fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column("text")]
        yield batch_of(out, batch.column("doc_id"), np.array(found, np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed number."""
    return docs.select(F.col("doc_id").cast("long"), as_text()).mapInArrow(
        lambda batches: _prints(batches, shingle), "doc_id long, fp long"
    )


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 planes of words: bit k of word w of plane b is bit b of fingerprint 64 w + k."""
    words = -(-len(prints) // 64)
    padded = np.zeros(words * 64, "<u8")
    padded[:len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8), bitorder="little").reshape(words, 64, 64)
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")[:, :, 0]


def near(planes: np.ndarray, queries: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each job (a query and a word of planes), the lanes within two bits of the query.

    ``ones`` and ``twos`` count modulo four; ``over`` keeps lanes that passed three.
    Jobs whose lanes are all over are left out from then on.
    """
    found = np.zeros(len(queries), np.uint64)
    live = np.arange(len(queries))
    ones, twos, over = (np.zeros(len(queries), np.uint64) for _ in range(3))
    full = ~np.uint64(0)
    for b in range(64):
        differ = planes[b][words] ^ (np.uint64(0) - (queries >> np.uint64(b) & np.uint64(1)))
        carry = ones & differ
        ones ^= differ
        over |= twos & carry
        twos ^= carry
        if b % 8 == 7:
            alive = (over | (ones & twos)) != full
            if alive.sum() < 0.8 * len(alive):
                live, queries, words = live[alive], queries[alive], words[alive]
                ones, twos, over = ones[alive], twos[alive], over[alive]
                if not len(live):
                    return found
    found[live] = ~(over | (ones & twos))
    return found


def link_groups(groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of groups of distinct fingerprints, each fingerprint that hangs together with a smaller one
    of its group by links, and the smallest such."""
    spans, columns, flat = [], 0, []
    for prints in groups:
        spans.append((columns, len(prints)))
        padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
        padded[:len(prints)] = prints
        flat.append(padded)
        columns += len(padded) // 64
    everything = np.concatenate(flat)
    planes = bit_planes(everything)
    # A job for each fingerprint and each word of its group from its own word on.
    sizes = np.array([n for _, n in spans])
    base = np.array([c for c, _ in spans])
    item = np.concatenate([np.arange(n) for n in sizes])
    group = np.repeat(np.arange(len(sizes)), sizes)
    own = base[group] + item // 64
    each = base[group] + -(-sizes[group] // 64) - own
    place = base[group] * 64 + item
    left, right = [], []
    ends = np.cumsum(each)
    at = 0
    while at < len(place):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _JOBS, "right")))
        n = each[at:to]
        query = np.repeat(place[at:to], n)
        word = np.repeat(own[at:to], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        lanes = near(planes, everything[query], word)
        hit = np.flatnonzero(lanes)
        bits = np.unpackbits(lanes[hit].view(np.uint8), bitorder="little").reshape(-1, 64)
        k, lane = np.nonzero(bits)
        a, b = query[hit][k], word[hit][k] * 64 + lane
        last = np.repeat(base * 64 + sizes, sizes)[np.searchsorted(place, a)]
        keep = (b > a) & (b < last)
        left.append(a[keep])
        right.append(b[keep])
        at = to
    a, b = np.concatenate(left), np.concatenate(right)
    # The smallest place that hangs together with each place; groups are sorted.
    root = np.arange(len(everything))
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(root)))
    return everything[moved], everything[root[moved]]


def _links(batches):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        groups, held = [], 0
        lists = batch.column("members")
        for i in range(len(lists)):
            groups.append(np.sort(lists[i].values.to_numpy().view(np.uint64)))
            held += len(groups[-1])
            if held > _JOBS or i == len(lists) - 1:
                a, b = link_groups(groups)
                yield batch_of(out, a.view(np.int64), b.view(np.int64))
                groups, held = [], 0


def linked(distinct: DataFrame, fp: str = "fp") -> DataFrame:
    """(a, b): links that connect distinct fingerprints of at most two differing bits.

    Every pair within the radius is compared; a group gives the links of its own
    components rather than all its pairs.
    """
    masks = []
    for chosen in combinations(range(8), 6):
        mask = sum(0xFF << (8 * k) for k in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    shared = F.array(*[F.col(fp).bitwiseAND(F.lit(m)) for m in masks])
    # A few bytes become 28 rows here, so the fingerprints are spread by number, not by size.
    spread = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), fp)
    keyed = spread.select(fp, F.posexplode(shared).alias("choice", "bits"))
    groups = keyed.groupBy("choice", "bits").agg(F.collect_list(fp).alias("members"))
    # Distinct fingerprints that share 48 bits: 65,536 at most.
    return groups.filter(F.size("members") > 1).select("members").mapInArrow(_links, "a long, b long")


def classes(printed: DataFrame) -> DataFrame:
    """(fp, root): each distinct fingerprint with the one that stands for its component."""
    distinct = stage(printed.select("fp").distinct(), "distinct")
    roots = components(linked(distinct)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id): every document with the smallest id it is linked to."""
    printed = stage(fingerprints(docs, shingle), "fingerprints")
    firsts = printed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = stage(classes(printed).join(firsts, "fp"), "named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    whole = named.join(least, "root").select("fp", "component_id")
    return printed.join(whole, "fp").select("doc_id", "fp", "component_id")


def _with_print(batches, shingle: int, column: str):
    for batch in batches:
        found = [fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.array(found, np.uint64).view(np.int64))], names=[*batch.schema.names, column])


def first_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, in its own columns: that of the smallest id, ids before nulls.

    Of several rows with that id in the component one stays.
    """
    fp, row = fresh("fp", docs.columns), fresh("row", docs.columns)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    printed = docs.withColumn("text", as_text()).mapInArrow(
        lambda batches: _with_print(batches, shingle, fp), f"{fields}, `{fp}` long")
    rows = stage(printed.withColumn(row, F.monotonically_increasing_id()), "printed")  # staged: the numbers stay
    narrow = rows.select(F.col(fp).alias("fp"), F.col(row).alias("row"), "doc_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = narrow.join(classes(narrow), "fp").groupBy("root").agg(F.min(order).alias("kept"))
    kept = kept.select(F.col("kept.row").alias(row))
    return rows.join(kept, row).select(*docs.columns)
