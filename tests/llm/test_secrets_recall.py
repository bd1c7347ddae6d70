"""Random keys among ordinary runs: recall by length, name=value, keys behind paths and prefixes."""

from __future__ import annotations

import numpy as np
import pytest

from fumeline.llm import secrets

SIGNS = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
NAMES = ("session Manager Request Handler water animal people City projekt Rechnung nombre travail Buffer index "
         "Http Token count size sales report final draft summer trabajo Leistung utils Core parse Xml Json").split()


def identifiers(rng, n, least, most):
    out = []
    while len(out) < n:
        own = "_-/"[rng.integers(3)] if rng.integers(2) else ""
        words = [str(w) for w in rng.choice(NAMES, 8)]
        if rng.integers(2):
            words[rng.integers(8)] += str(rng.integers(1, 3000))
        run = own.join(words)[:rng.integers(least, most)].strip("_-/")
        if len(run) >= least:
            out.append(run)
    return out


@pytest.mark.parametrize("length", [20, 24, 32, 40])
def test_keys_at_one_in_a_hundred(spark, length):
    rng = np.random.default_rng(length)
    keys = ["".join(rng.choice(SIGNS, length)) for _ in range(20)]
    plain = identifiers(rng, 1980, length - 4 if length > 24 else 20, length + 4)
    made = [(k, f"see {t} there") for k, t in enumerate(keys + plain)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    found = {r["doc_id"] for r in secrets.secrets(df).collect() if f"random:4:{4 + len(made[r['doc_id']][1]) - 10}" in r["spans"]}
    assert len(found & set(range(20))) >= 19
    assert len(found - set(range(20))) <= 3


def test_values_after_names_paths_and_prefixes(spark):
    rng = np.random.default_rng(1)
    before = ["aws_secret_access_key=", "auth_key=", "sig=", "pwd=", "/usr/local/my-dir/", "some-dashed_prefix/",
              "a=b==", "https://host/path_to-it/"]
    made, want = [], {}
    for k, name in enumerate(before):
        key = "".join(rng.choice(SIGNS, 40))
        made.append((k, f"é {name}{key} x"))
        want[k] = f"random:{2 + len(name)}:{2 + len(name) + 40}"
    key = "".join(rng.choice(SIGNS, 42))
    made.append((len(made), f"k={key}== x"))
    want[len(made) - 1] = "random:2:46"
    found = {r["doc_id"]: r["spans"] for r in secrets.secrets(
        spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert all(want[k] in found[k] for k in want), found
