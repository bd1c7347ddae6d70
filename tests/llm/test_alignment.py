"""Links between two tokenizers' tokens, against a plain version over tokens' byte ranges."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fumeline.llm import alignment
from tests.llm import corpus


@pytest.fixture(scope="module")
def pair():
    return alignment.read_pair()[2]


def plain(texts, pair):
    """Per text: (n_a, n_b, n_groups, n_links, n_best, count_sum, digest)."""
    held, docs = Counter(), []
    for text in texts:
        text = text or ""
        want = b" " + text.encode()
        a = pair.slow.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pair.second.encode(text) if text else []
        if not text or any(b"".join(v[i] for i in ids) != want for ids, v in (
                (a, pair.first_bytes), (b, pair.second_bytes))):
            docs.append(None)
            continue
        groups, at, i, j, to_a, to_b = [], ([], []), 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if to_a <= to_b and i < len(a):
                at[0].append(a[i])
                to_a += len(pair.first_bytes[a[i]])
                i += 1
            else:
                at[1].append(b[j])
                to_b += len(pair.second_bytes[b[j]])
                j += 1
            if to_a == to_b:
                groups.append(at)
                at = ([], [])
        links = Counter((x, y) for own in groups for x in own[0] for y in own[1])
        held.update(set(links))
        docs.append((len(a), len(b), groups, links))
    top: dict[int, int] = {}
    for (x, _), n in held.items():
        top[x] = max(n, top.get(x, 0))
    out = []
    for doc in docs:
        if doc is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = doc
        named = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(t for p, t in links.items() if held[p] == top[p[0]]),
                    sum(t * held[p] for p, t in links.items()), hashlib.sha256(named.encode()).hexdigest()))
    return out


ODD = ["<|endoftext|> plain", "<s> and </s> <unk> <0x41>", "▁ low line", "  spaces   between  ", "tabs\tand\nlines\r\n",
       "aaaaaaaaaaaaaaaa" * 40, "======\n\n\n======", "日本語のテキスト", "🙂🙂🙃 emoji", "é combining", "ﬁ ligature",
       " nbsp　wide", "don't we'll I'VE", "12345 678,90", "\x00 null", " leading", "trailing ", "ababababab" * 30,
       "x" * 2500, " " * 2500, "​ zero width ﻿"]
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_against_plain(spark, pair):
    docs = corpus.documents(spark)
    docs = docs.unionByName(spark.createDataFrame([(1000 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string"),
                            allowMissingColumns=True)
    given = docs.select("doc_id", "text").collect()
    want = sorted(map(repr, ((r["doc_id"], *w) for r, w in zip(given, plain([r["text"] for r in given], pair)))))
    for hot in (alignment.HOT, 4):  # nearly all pairs from the array, or joined
        got = alignment.linked(docs, hot=hot).select("doc_id", *NAMES).collect()
        assert sorted(repr(tuple(r)) for r in got) == want


def test_special_strings_are_text(spark, pair):
    rows = alignment.linked(spark.createDataFrame([(1, "<|endoftext|>")], "doc_id long, text string")).first()
    assert rows["n_a"] > 1


def test_empty_table(spark):
    got = alignment.linked(spark.createDataFrame([], "doc_id long, text string"))
    assert got.count() == 0 and got.columns == ["doc_id", *NAMES]


def test_merging_by_id(pair):
    """The fast way gives the ids of the file's own merges."""
    assert pair.by_id
    rng = random.Random(5)
    texts = ["".join(rng.choice("aab etthe'sé1.-\n") for _ in range(rng.randint(1, 300))) for _ in range(2000)]
    texts += [" ".join(corpus.words(rng, 50)) for _ in range(200)]
    assert pair.first_ids(texts) == [x.ids for x in pair.slow.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_identity_map(pair):
    same = pair.same()
    known = np.flatnonzero(same >= 0)
    assert len(known) > 5000
    assert all(pair.first_bytes[i] == pair.second_bytes[same[i]] for i in known)


def test_very_long_text(spark, pair):
    long = " ".join(corpus.words(random.Random(2), 300_000))
    assert len(long) > 1 << 20
    got = alignment.linked(spark.createDataFrame([(1, long), (2, "short")], "doc_id long, text string")).collect()
    want = plain([long, "short"], pair)
    assert {r["doc_id"]: tuple(r[n] for n in NAMES) for r in got} == {1: want[0], 2: want[1]}
