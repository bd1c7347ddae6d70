"""A small corpus with the odd cases that every operator must stand."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, "
          # Names that operators use for columns of their own.
          "score double, size long, chunk long, bucket long, fp long, row long, spans string, items string, "
          "n_words long, label int, code int, train boolean")
JUNK, SPARE = ("%%%", "###", "&&&"), (None,) * 12


def words(rng: random.Random, n: int) -> list[str]:
    parts = ["ka", "lo", "mi", "ter", "san", "du", "vel", "or", "ent", "ish", "éa", "ñu"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def texts(seed: int = 1, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    out: list[str | None] = [" ".join(words(rng, rng.randint(20, 160))) for _ in range(n)]
    passage = " ".join(words(rng, 60))
    for k in range(0, n, 7):  # a passage that documents share
        out[k] = f"{out[k]} {passage} {' '.join(words(rng, 9))}"
    out += [out[1], out[1], out[2].replace(" ", "\n", 3), out[3].upper()]  # copies, spaced or cased differently
    long = words(rng, 3000)
    out += [" ".join(long * 3), " ".join(["same"] * 400), None, "", " \t\n\x0b\x0c\r", "one", "one two", "x" * 5000,
            "nbsp stays one word", "\x00\x1f null byte"]
    return out


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    given = texts(seed, n)
    made = [(k, t, "en", None if k % 11 == 0 else f"s{k % 4}", len(t or ""), *SPARE) for k, t in enumerate(given)]
    made += [made[4], made[4]]  # repeated rows
    made += [(None, given[5], None, None, None, *SPARE), (None, None, None, None, None, *SPARE)]
    return made


def documents(spark, seed: int = 1, n: int = 60):
    return spark.createDataFrame(rows(seed, n), SCHEMA).repartition(3)


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()
