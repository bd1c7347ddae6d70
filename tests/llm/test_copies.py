"""The pipeline's near-duplicate stage next to Jaccard similarity by brute force."""

from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from fumeline.llm import copies, simhash
from tests.llm import corpus


def parts_of(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def changed(rng, words, n):
    """``n`` words replaced, far apart: five shingles go for each."""
    out = list(words)
    for k in range(n):
        out[k * (len(words) // n) + 5] = f"new{rng.random()}"
    return out


def test_stage_links_all_of_jaccard_four_fifths(spark):
    rng, texts = random.Random(7), []
    for k in range(30):
        own = corpus.words(rng, rng.randint(20, 400))
        least = max(1, len(own) // 50)
        # Jaccard from just above 0.8 to below it, and copies of copies.
        texts += [" ".join(w) for w in (own, changed(rng, own, least), changed(rng, own, 2 * least),
                                        changed(rng, changed(rng, own, least), least), own[:-3], own[len(own) // 4:])]
    base = corpus.words(rng, 300)
    texts += [" ".join(changed(rng, base, 4)) for _ in range(25)] + texts[:3] + [None, "", "one", "One", "one two"]
    sets = [parts_of(t) for t in texts]
    root = list(range(len(texts)))
    far = 0
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                own, other = (simhash.fingerprint((texts[k] or "").encode()) for k in (i, j))
                far += (own ^ other).bit_count() > 2
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert far > 40  # pairs that operator 4's rule leaves apart
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = [r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, "").collect()]
    assert sorted(kept) == sorted(set(root))


def test_keys_meet_at_four_fifths():
    rng = np.random.default_rng(5)
    for _ in range(300):
        hashes = rng.integers(0, 1 << 63, 90, np.uint64) * np.uint64(2)
        a, b = hashes[:81], hashes[9:]  # 72 of 90
        assert set(copies.keys(a)) & set(copies.keys(b))


def kept_by_brute_force(texts):
    sets, root = [parts_of(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return sorted(set(root))


def test_family_in_blocks(spark, monkeypatch):
    """Many sets that share keys, most of them not similar enough, in one block or many."""
    rng = random.Random(11)
    base = corpus.words(rng, 200)
    texts = [" ".join(changed(rng, base, rng.randint(1, 9))) for _ in range(160)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = kept_by_brute_force(texts)
    assert 10 < len(want) < 150
    for most in (copies.BLOCK_SETS, 25):
        monkeypatch.setattr(copies, "BLOCK_SETS", most)
        assert sorted(r["doc_id"] for r in copies.first_of_each(docs).collect()) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, mark string")
    found = copies.first_of_each(docs)
    assert found.count() == 0 and found.columns == docs.columns


def test_staged_tables_are_dropped(spark):
    from pathlib import Path

    from fumeline.session import stage_root

    root = Path(stage_root(spark))
    before = set(root.iterdir())
    copies.first_of_each(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")], "doc_id long, text string")).collect()
    # The numbered rows and what is kept of them are still read.
    left = sorted(p.name.partition("-")[0] for p in set(root.iterdir()) - before if any(p.glob("*.parquet")))
    assert left == ["kept", "marked"]


def test_operator_four_finds_its_own(spark):
    """Sets that share no key are linked by their fingerprints, if they are similar enough."""
    rng, texts = random.Random(3), []
    while len(texts) < 12:
        own = corpus.words(rng, 400)
        pair = [" ".join(own), " ".join([*own[:200], "another", *own[201:]])]
        prints = [simhash.fingerprint(t.encode(), copies.SHINGLE) for t in pair]
        if 0 < (prints[0] ^ prints[1]).bit_count() <= 2:
            texts += pair
    prints = np.array([simhash.fingerprint(t.encode(), copies.SHINGLE) for t in texts], np.uint64).view(np.int64).tolist()
    # The last has the first's fingerprint, and nothing else of it.
    rows = [(k, [k], p, t) for k, (p, t) in enumerate(zip(prints, texts))] + [(12, [12], prints[0], "none of these words")]
    nodes = spark.createDataFrame(rows, "node long, keys array<long>, fp long, text string").cache()
    found = copies.links(nodes.drop("text"), nodes.select("node", "text")).collect()
    assert sorted((r["a"], r["b"]) for r in found) == [(k, k + 1) for k in range(0, 12, 2)]
