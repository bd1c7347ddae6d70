"""Dictionaries from labelled text: windows and counts by plain loops, telling strings wherever they stand."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fumeline.llm import toxicity
from fumeline.llm.common import remainder
from tests.llm import corpus


def batch(texts, labels=None):
    return pa.record_batch({"text": pa.array(texts, pa.string()), "label": pa.array(labels or [0] * len(texts), pa.int32())})


def plain_windows(text: str) -> list[bytes]:
    out, whole = [], text.encode().lower()
    spots, at = [], 0
    for word in whole.split():
        at = whole.index(word, at)
        spots.append((at, at + len(word)))
        at += len(word)
    for k in range(0, len(spots), toxicity.WORDS):
        start, end = spots[k][0], spots[min(k + toxicity.WORDS, len(spots)) - 1][1]
        while True:
            out.append(b" ".join(whole[start:min(end, start + toxicity.MOST)].split(b"\n")))
            if end - start <= toxicity.MOST:
                break
            start += toxicity.STEP
    return out


def test_windows_and_savings_by_plain_loops():
    rng = random.Random(5)
    texts = ["", " ", "One", "x" * 500, "é" * 97 + " a\nb", *(" ".join(corpus.words(rng, n)) for n in (3, 4, 5, 90))]
    data, at = toxicity._lowered(batch(texts))
    text, start, end = toxicity.windows(data, at)
    want = [(k, w) for k, t in enumerate(texts) for w in plain_windows(t)]
    assert [(k, data[s:e].tobytes()) for k, s, e in zip(text.tolist(), start, end)] == want
    coders = toxicity._coders(toxicity.Model(b" usual words and moronic ", b" usual words ", ()))
    _, got = toxicity.savings(data, at, coders)
    sizes = [[len(c.compress(toxicity.PRIMER + b" " + w + toxicity.TAIL)) for _, w in want] for c in coders]
    assert got.tolist() == [o - t for t, o in zip(*sizes)]


def test_counts_by_plain_loops():
    texts, labels = ["ab cd ef gh", "AB cd ef", "été ab cd", "", "xyz"], [1, 0, 1, 1, 0]
    data, at = toxicity._lowered(batch(texts, labels))
    names = {}
    for s, e in zip(at[:-1], at[1:]):
        for size, starts, hashes in toxicity._strings(data[s:e]):
            names.update({int(h): data[s + k:s + k + size].tobytes() for k, h in zip(starts, hashes)})
    seeds = np.array(sorted(names), np.uint64)
    (got,) = toxicity._counted([batch(texts, labels)], seeds)
    for h, t, o in zip(*(got.column(n).to_pylist() for n in ("hash", "t", "o"))):
        string = names[h % (1 << 64)]
        held = [string in x.lower().encode() for x in texts]
        assert (t, o) == (sum(x and y for x, y in zip(held, labels)), sum(x and not y for x, y in zip(held, labels)))
        string.decode()  # begins and ends between characters


KINDS = {
    "inside words": lambda rng, own: [*own, *(f"{rng.choice(own)}zupfo{rng.choice(own)}" for _ in range(4))],
    "phrases": lambda rng, own: [*own, *(["vile", "old", "gnalb"] * 4)],
    "unspaced": lambda rng, own: ["".join(chr(0x4E00 + zlib.crc32(w.encode()) % 500) + ("白痴" if k % 9 == 3 else "")
                                          for k, w in enumerate(own))],
}


@pytest.mark.parametrize("kind", KINDS)
def test_telling_strings_anywhere(spark, kind):
    rng, docs, labels = random.Random(7), [], []
    for k in range(700):
        own = corpus.words(rng, rng.randint(40, 90))
        if k % 5 == 0:
            own = KINDS[kind](rng, own)
        elif kind == "unspaced":
            own = ["".join(chr(0x4E00 + zlib.crc32(w.encode()) % 500) for w in own)]
        docs.append((k, " ".join(own)))
        labels.append((k, int(k % 5 == 0)))
    docs += [(k, docs[0][1]) for k in range(700, 760)]  # copies teach once
    labels += [(k, 1) for k in range(700, 760)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, remainder("doc_id", 3) != 1)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [k for k in range(700) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert sum(got[k] >= 0.7 for k in held if k % 5 == 0) >= 0.9 * sum(k % 5 == 0 for k in held)
    assert sum(got[k] >= 0.7 for k in held if k % 5) <= 0.01 * len(held)
