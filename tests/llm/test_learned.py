"""Operators that learn, by held-out accuracy and recall; and all of them on empty tables."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from fumeline.llm import anchors, decontaminate, itq, lattice, mixing, quality, secrets, simhash, suffixes, toxicity
from fumeline.llm.common import remainder
from fumeline.llm.components import components
from tests.llm import corpus

BAD = ["trashy", "moronic", "worthless"]


@pytest.fixture(scope="module")
def labelled(spark):
    """900 documents: every sixth holds insults, every fifth is junk."""
    rng, docs, labels = random.Random(3), [], []
    for k in range(900):
        own = corpus.words(rng, rng.randint(30, 120))
        toxic, junk = k % 6 == 0, k % 5 == 0
        if toxic:
            for _ in range(4):
                own.insert(rng.randrange(len(own)), rng.choice(BAD))
        if junk:
            own = [w + rng.choice(corpus.JUNK) for w in own]
        docs.append((k, " ".join(own)))
        labels.append((k, int(not junk), int(toxic)))
    docs += [(None, "x"), (901, None), (902, "")]
    labels += [(1, None, None), (2, 1, 0), (2, 0, 0), (None, 1, 1), (5000, 1, 1), (901, 1, 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3).cache(),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache())


def scored(df):
    return {r["doc_id"]: r["score"] for r in df.collect()}


def test_quality(labelled):
    docs, labels = labelled
    weights = quality.fit(docs, labels, "quality", remainder("doc_id", 5) != 0)
    got = scored(quality.score(docs, weights))
    assert len(got) == 903 and all(0 <= s <= 1 for s in got.values())
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum((got[k] >= 0.3) == (k % 5 != 0) for k in held) >= 0.98 * len(held)
    kept = quality.accepted(docs, weights, 0.3)
    assert {r["doc_id"] for r in kept.collect()} == {k for k, s in got.items() if s >= 0.3}
    assert kept.columns == docs.columns


def test_toxicity(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels, remainder("doc_id", 3) != 1)
    assert all(w[:6].encode() in model.toxic for w in BAD)
    got = scored(toxicity.score(docs, model))
    assert len(got) == 903 and all(0 <= s <= 1 for s in got.values())
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 3 == 1]
    toxic = [k for k in held if k % 6 == 0]
    assert sum(got[k] >= 0.7 for k in toxic) >= 0.95 * len(toxic)
    assert sum(got[k] >= 0.7 for k in held if k % 6) <= 0.01 * len(held)


def test_no_labels(spark, labelled):
    docs, labels = labelled
    none = labels.filter("false")
    assert set(scored(quality.score(docs, quality.fit(docs, none, "quality"))).values()) == {0.5}
    assert max(scored(toxicity.score(docs, toxicity.fit(docs, none))).values()) < 1e-6
    one = labels.filter("toxic = 1")
    assert min(scored(toxicity.score(docs, toxicity.fit(docs, one))).values()) > 1 - 1e-6


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    made = [base]
    for cosine in (0.85, 0.9001, 0.92, 0.97, 0.999):
        side = rng.normal(size=base.shape)
        side -= (side * base).sum(1, keepdims=True) * base
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        made.append(3 * (cosine * base + np.sqrt(1 - cosine ** 2) * side))
    rows = [[float(x) for x in v] for v in np.concatenate(made)]
    return rows + [rows[0], rows[0], rows[7]]  # exact copies


def test_itq(spark):
    rows = [(k, v) for k, v in enumerate(vectors())]
    odd = [(9001, None), (9002, [0.0] * 64), (9003, [1.0] * 63 + [float("nan")]), (9004, [1.0] * 63 + [None]),
           (9005, [float("inf")] + [1.0] * 63), (9006, []), (9007, [1.0, 2.0]), (9008, [2.0, 4.0]), (3, rows[3][1]),
           (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in itq.near_duplicates(df).collect()}
    assert len(got) == len(rows) + 9
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    links = link.sum(1)
    assert all(got[k]["n_links"] <= links[k] for k in range(len(rows)))  # none below the threshold
    assert sum(got[k]["n_links"] for k in range(len(rows))) >= 0.95 * links.sum()
    root = np.arange(len(rows))
    for _ in range(20):
        root = np.minimum(root, np.where(link, root[None, :], len(rows)).min(1))
    assert sum(got[k]["component_id"] == root[k] for k in range(len(rows))) >= 0.95 * len(rows)
    for k in (9001, 9002, 9003, 9004, 9005, 9006, None):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (0, k, True)
    assert [got[k]["n_links"] for k in (9007, 9008)] == [1, 1] and got[9008]["component_id"] == 9007


def test_itq_long_lists_are_cut(spark):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 62, 40)
    for flip in (1, 1 << 5, 1 << 17, (1 << 33) | 3):
        codes = np.concatenate([codes, codes[:40] ^ flip])
    codes = np.unique(codes)
    df = spark.createDataFrame([(int(c),) for c in codes], "code long")
    whole = sorted(map(tuple, itq.code_pairs(df, 4, radius=6).collect()))
    assert whole == sorted(map(tuple, itq.code_pairs(df, 4, radius=6, longest=3).collect()))
    want = sorted((min(a, b), max(a, b)) for k, a in enumerate(codes.tolist()) for b in codes.tolist()[k + 1:]
                  if (a ^ b).bit_count() <= 6)
    assert whole == want


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7), (20, 20), (None, 3), (5, 1), (2, 1)]
    links += [(100, k) for k in range(101, 140)] + [(k, k + 1) for k in range(200, 230)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {2: 1, 3: 1, 4: 1, 5: 1, 8: 7, 9: 7} | {k: 100 for k in range(101, 140)} | {k: 200 for k in range(201, 231)}
    assert got == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], corpus.SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = corpus.documents(spark, n=5)
    empty = [
        toxicity.score(docs, toxicity.fit(docs, labels)), itq.near_duplicates(
            spark.createDataFrame([], "vec_id long, embedding array<float>")),
        mixing.taken(docs), mixing.mixture(docs), simhash.near_duplicates(docs), simhash.first_of_each(docs),
        suffixes.deduplicated(docs), anchors.deduplicated(docs), lattice.scores(docs, remainder("doc_id", 5) != 1),
        secrets.secrets(docs), secrets.redacted(docs), quality.accepted(docs, quality.fit(docs, labels, "quality"), 0.3),
        decontaminate.contaminated(docs, bench), decontaminate.decontaminated(docs, bench),
    ]
    assert [df.count() for df in empty] == [0] * len(empty)
    clean = decontaminate.contaminated(some, bench).collect()
    assert len(clean) == some.count() and not any(r["contaminated"] for r in clean)
