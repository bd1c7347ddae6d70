"""Benchmark items without an id are searched like any other."""

from __future__ import annotations

import hashlib

from fumeline.llm import decontaminate


def test_items_without_an_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(12)) for x in "abc")
    benchmark = spark.createDataFrame([(None, a), (None, b), (7, c)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {a} y"), (2, f"{a} x {b} {c}"), (3, f"x {c}"), (4, "x")], "doc_id long, text string")
    for pass_bytes in (decontaminate.PASS_BYTES, 60):
        found = decontaminate.contamination(docs, benchmark, pass_bytes=pass_bytes)
        assert {r["doc_id"]: r["items"] for r in found.collect()} == {1: [None], 2: ["7", None], 3: ["7"], 4: []}
    got = {r["doc_id"]: r for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert [got[k]["n_hit"] for k in (1, 2, 3, 4)] == [12, 36, 12, 0]
    assert [got[k]["n_items"] for k in (1, 2, 3, 4)] == [1, 2, 1, 0]
    told = [hashlib.sha256(t).hexdigest() for t in (b"", b"7", b"7", b"")]
    assert [got[k]["items_sha256"] for k in (1, 2, 3, 4)] == told
    clean = {r["doc_id"]: r["text"].split() for r in decontaminate.decontaminated(docs, benchmark).collect()}
    assert clean == {1: ["x", "y"], 2: ["x"], 3: ["x"], 4: ["x"]}
