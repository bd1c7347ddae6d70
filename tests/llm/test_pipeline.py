"""The pipeline, stage by stage, next to brute force on the smallest tables and on odd rows."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from fumeline.llm import quality
from fumeline.llm.common import remainder, table
from tests.llm import corpus
from tests.llm.test_copies import parts_of
from tests.llm.test_exact import cut

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    steps = [step for _, step in corpus_pipeline.STAGES]

    good = steps[0](spark, docs, SF).cache()
    weights = quality.fit(docs, table(spark, SF, "labels"), "quality", remainder("doc_id", 5) != 0)
    score = {r["doc_id"]: r["score"] for r in quality.score(docs, weights).collect()}
    assert {r["doc_id"] for r in good.collect()} == {k for k, s in score.items() if s >= 0.3}

    single = steps[1](spark, good, SF).cache()
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    ids = sorted(texts)
    # Five words and a Jaccard similarity of 0.8, linked transitively.
    sets, root = [parts_of(texts[k]) for k in ids], list(range(len(ids)))
    for i, own in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and len(own & sets[j]) >= 0.8 * len(own | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({ids[k] for k in root})

    clean = steps[2](spark, single, SF).cache()
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        words = cut(r["text"])
        windows |= {tuple(words[i:i + 10]) for i in range(len(words) - 9)}
    held = Counter()
    for r in clean.collect():
        words, before = cut(r["text"]), cut(texts[r["doc_id"]])
        gone = set()
        for i in range(len(before) - 9):
            if tuple(before[i:i + 10]) in windows:
                gone.update(range(i, i + 10))
        assert words == [w for i, w in enumerate(before) if i not in gone]
        assert r["n_chars"] == len(r["text"])
        held[bool(gone)] += 1
    assert held[True] and clean.count() == single.count()

    masked = steps[3](spark, clean, SF).cache()
    assert masked.count() == clean.count()
    assert not masked.filter("text rlike '[0-9a-f]{16,}|AKIA[A-Z0-9]{14,}'").count()
    for df in (good, single, clean, masked):
        assert df.dtypes == docs.dtypes

    mix = steps[4](spark, masked, SF)
    whole = sum(len(corpus.split(r["text"])) for r in masked.collect())
    assert abs(sum(r["words"] for r in mix.collect()) - whole) < 0.02 * whole


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_odd_rows(spark):
    """Nulls, repeated rows and columns with the operators' names go through every stage."""
    docs = corpus.documents(spark)
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, docs, SF)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        after = after.cache()
        assert after.count() <= docs.count()
        if name in ("decontaminate", "secrets"):
            assert after.count() == docs.count()
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
