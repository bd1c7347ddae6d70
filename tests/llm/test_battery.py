"""The tests of randomness against a plain computation, one character at a time."""

from __future__ import annotations

import math

import numpy as np
import pytest

from fumeline.llm import secrets

LOWER = "abcdefghijklmnopqrstuvwxyz"


def plain(text, alphabet):
    n, size, vowels = len(text), len(alphabet), "aeiouy"
    cells = {}
    for c in alphabet:
        cells[c.lower()] = cells.get(c.lower(), 0) + 1
    chi = 0.0
    for c, width in cells.items():
        expected = n * width / size
        chi += (sum(x.lower() == c for x in text) - expected) ** 2 / expected

    def kind(c):
        if alphabet.isalpha() and (alphabet.islower() or alphabet.isupper()):
            return "vowel" if c.lower() in vowels else "other"
        return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "sign"

    runs = 0
    for a, b in zip(map(kind, text), map(kind, text[1:])):
        runs += a != b and a != "sign" and (a, b) != ("upper", "lower")
    at = [alphabet.index(c) for c in text]
    mean = sum(at) / n
    square = sum((x - mean) ** 2 for x in at)
    serial = sum((x - mean) * (y - mean) for x, y in zip(at, at[1:])) / square if square else 1.0
    sound = [(1 if c.lower() in vowels else -1) if c.isalpha() else 0 for c in text]
    return chi, runs, serial, sum(x * y for x, y in zip(sound, sound[1:])) / (n - 1)


def drawn(rng, alphabet, n):
    return "".join(rng.choice(list(alphabet), n))


def test_statistics():
    rng = np.random.default_rng(2)
    for alphabet in (a.decode() for a, _ in secrets.ENCODINGS):
        texts = [drawn(rng, alphabet, 33) for _ in range(5)] + [alphabet[0] * 33, (alphabet[:3] * 11)]
        got = secrets.statistics(np.array([[alphabet.index(c) for c in t] for t in texts]), alphabet.encode())
        assert np.allclose(got, [plain(t, alphabet) for t in texts])


@pytest.mark.parametrize("text", ["Zq8Lw2xKp0VtR5mYb7NcJ3", "readTheWholeBufferAndCount", "qzjxkvwpfbhgmtrcnsdl"])
def test_p_value(text):
    """Fisher's sum and its law, step by step."""
    alphabet = secrets.encoding(text.encode())
    law, own = secrets.spread(alphabet, len(text)), plain(text, alphabet.decode())
    equal, ordinary = secrets._draws(alphabet)
    equal, ordinary = (secrets.statistics(x[:, :len(text)], alphabet) for x in (equal, ordinary))
    side = [1 if e > t else -1 for e, t in zip(equal.mean(0), ordinary.mean(0))]

    def fisher(row):
        z = [(x - m) / s * w for x, m, s, w in zip(row, ordinary.mean(0), ordinary.std(0), side)]
        return -2 * sum(math.log(0.5 * math.erfc(x / math.sqrt(2))) for x in z)

    sums = [fisher(row) for row in ordinary]
    mean, variance = np.mean(sums), np.var(sums)
    assert (law.mean, law.variance) == (pytest.approx(mean), pytest.approx(variance))
    freedom = 2 * mean ** 2 / variance
    root = (fisher(own) / (variance / (2 * mean) * freedom)) ** (1 / 3)
    z = (root - 1 + 2 / (9 * freedom)) / math.sqrt(2 / (9 * freedom))
    off, _, p = secrets.battery(text.encode())
    assert p == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)))
    assert off == pytest.approx((np.array(own) - equal.mean(0)) / equal.std(0))


def test_text_seldom_looks_random():
    """P-values of ordinary runs other than those the law was measured on are not too small."""
    alphabet = secrets.encoding(b"aZ0")
    assert alphabet == secrets.ENCODINGS[7][0]
    secrets._drawn.pop(alphabet, None)
    _, text = secrets._draws(alphabet)
    words = [bytes(alphabet[c] for c in row[100:130]) for row in text]
    tested = [secrets.ordinary(w) for w in words if secrets.encoding(w) == alphabet]
    assert len(tested) > 1000
    for p in (0.05, 0.01, 0.001):
        assert np.mean([x < p for x in tested]) < 2 * p + 0.001


def test_what_is_not_random():
    for run in ("a1" * 15, LOWER, LOWER.upper() + "0123456789", "xyz" * 9, "z" * 40, "0123456789" * 4, "-" * 30):
        assert secrets.ordinary(run.encode()) == 1.0


def test_one_case_and_long_runs(spark):
    rng = np.random.default_rng(4)
    runs = [drawn(rng, LOWER, 64) for _ in range(10)] + [drawn(rng, LOWER.upper(), 64) for _ in range(10)]
    runs += [drawn(rng, LOWER + LOWER.upper() + "0123456789+/", 1 << 20), "thewaterandtheanimal" * 50_000]
    df = spark.createDataFrame([(k, f"é {t} x", 1) for k, t in enumerate(runs)], "doc_id long, text string, score int")
    found = {r["doc_id"]: r["spans"] for r in secrets.secrets(df).collect()}
    assert sum(found[k] == "random:2:66" for k in range(20)) >= 18
    assert found[20] == f"random:2:{2 + (1 << 20)}" and found[21] == ""
