"""Secret scans: fixed patterns, and a battery of randomness tests (operator 8).

Patterns: assignments to telling names, access keys, long hex runs. Spans are code
points, end exclusive. Beyond them, every run of 20 or more characters of
``A-Za-z0-9+/_-`` (with up to two ``=`` as padding after it), whole or cut at its signs,
that holds a letter goes through a battery of tests within the smallest encoding that fits it
(hex, base 32, letters of one case, letters, letters and digits, base 64):

* chi-squared: how far its characters are from equal shares of the alphabet (both cases of
  a letter count as one);
* runs: how often neighbours differ in class (lower case, upper case, digit, sign; for
  letters of one case vowel or not); upper case goes with lower case after it and a sign
  with anything, as in words and between them;
* serial correlation: that of neighbours' places in the alphabet, and that of vowels and
  other letters.

How these statistics spread, at every length, is measured on drawn runs of two kinds:
equal shares, and ordinary text (letters after one another as in a fixed word list,
changes of class at fixed rates). A run that differs from equal shares by more than
``APART`` standard deviations in any test is not random. For the others each test's
p-value says how likely ordinary text comes as near to equal shares; they are put together
by Fisher's sum, whose spread under ordinary text, with the tests' covariance, is measured
on the same draws. Runs of over ``BLOCK`` characters are tested in blocks whose deviations
add up. Uneven letters alone are weak evidence, so keys of one case need to be longer.
The share of false discoveries is held by Benjamini-Hochberg over all runs of the corpus,
separately per length class (doublings). P-values are rounded up to steps of exp(-0.25)
first, so that counts per step decide exactly.

Cases: a null or empty text has no spans and the hash of the empty string. Repeated
documents are scanned each by itself. Columns other than ``doc_id`` and ``text`` are
not read.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fumeline.llm.common import _Kept, as_text, batch_of, slices, text_bytes, word_bounds
from fumeline.session import stage

# The patterns, their least lengths, and the order of kinds.
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 12, "access": 18, "hex": 16, "random": 20}
FALSE_SHARE = 0.05  # of all runs reported as random

_ASSIGN, _ACCESS = re.compile(ASSIGN, re.IGNORECASE), re.compile(ACCESS)
_NAMES = (b"passw", b"secret", b"token", b"api")
_STEP = 0.25  # of -ln p
_STEPS = 240


def _table(*ranges: bytes, extra: bytes = b"") -> np.ndarray:
    inside = np.zeros(256, bool)
    for r in ranges:
        inside[r[0]:r[1] + 1] = True
    inside[list(extra)] = True
    return inside


_HEX = _table(b"09", b"af")
_RUN = _table(b"09", b"AZ", b"az", extra=b"+/_-")
# Ways to cut a run: not at all, at the signs of the one or the other base 64, at all signs; padding stays.
_WAYS = [re.compile(rb"[A-Za-z0-9" + signs + rb"]+=*") for signs in (rb"+/_-", rb"+/", rb"_-", rb"")]
# Encodings by growing alphabet; the first that holds a run is taken.
ENCODINGS = (
    (b"0123456789abcdef", True), (b"0123456789ABCDEF", True),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", True),
    (b"abcdefghijklmnopqrstuvwxyz", False), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", False),
    (b"0123456789abcdefghijklmnopqrstuvwxyz", True),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", False),
    (b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", False),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", False),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", False),
)


# Ordinary text: letters after one another are learned from these words, changes of class are fixed.
_WORDS = """the of and to in is that for it was on are as with his they be at one have this from or had by hot but
some what there we can out other were all your when up use word how said an each she which do their time if will
way about many then them would write like so these her long make thing see him two has look more day could go come
did my sound no most number who over know water than call first people may down side been now find any new work part
take get place made live where after back little only round man year came show every good give our under name very
through just form much great think say help low line before turn cause same mean differ move right boy old too does
tell sentence set three want air well also play small end put home read hand port large spell add even land here must
big high such follow act why ask men change went light kind off need house picture try us again animal point mother
world near build self earth father user default config password value index string buffer request response server
client handler update delete create error message version system service manager factory process thread session token
public private static class function return import module object method param result number count length data file
path type status state event query table column filter group order test example project github master branch source
der die und den von zu das mit sich des auf nicht ein eine als auch es an werden aus er hat dass sie nach wird bei
einer um am sind noch wie einem ueber einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde
gesellschaft einheit verarbeitung schiff fahrt arbeit zeit jahr haus stadt rechnung leistung versicherung
le la les et des en un une que est pour qui dans par plus pas au sur ne se ce il sont avec son aux ou comme mais nous
vous elle tout fait cette leur bien deux meme etre temps ville monde jour question projet travail information
el los las del por con no para su al lo como mas pero sus ya porque cuando muy sin sobre entre ser tiene tambien
hasta hay donde quien desde todo nos durante todos uno ciudad tiempo trabajo nuestro gobierno empresa numero"""
# From each class (lower case, upper case, digits, signs) to each.
_TURNS = np.array([[.85, .07, .03, .05], [.55, .35, .05, .05], [.12, .08, .65, .15], [.50, .20, .25, .05]])
_FIRST = np.array([.55, .30, .10, .05])
DRAWS = 4000  # runs of either kind that the tests' spread is measured on
BLOCK = 256  # characters that are tested at once, at most
APART = 4.0  # standard deviations from equal shares that tell a run is not random


def _kinds(signs: bytes) -> np.ndarray:
    return np.array([0 if 0x61 <= c <= 0x7A else 1 if 0x41 <= c <= 0x5A else 2 if 0x30 <= c <= 0x39 else 3
                     for c in signs])


# Plain: a decorated function would be sent by name, which executors need not know.
_drawn, _spreads = _Kept(), _Kept()


def _text_law(alphabet: bytes) -> tuple[np.ndarray, np.ndarray]:
    """How likely text starts with each sign, and goes on with each after each, within the alphabet."""
    pairs, single = np.zeros((26, 26)), np.ones(26)
    for word in _WORDS.encode().split():
        at = np.frombuffer(word, np.uint8).astype(int) - 0x61
        np.add.at(single, at, 1)
        np.add.at(pairs, (at[:-1], at[1:]), 1)
    single /= single.sum()
    pairs = (pairs + 8 * single) / (pairs.sum(1, keepdims=True) + 8)
    kind = _kinds(alphabet)
    letter = np.array([(c | 0x20) - 0x61 if k < 2 else 0 for c, k in zip(alphabet, kind)])
    flat = np.where(kind < 2, single[letter], np.where(kind == 2, 0.1, 0.5))
    after = np.where((kind[:, None] < 2) & (kind < 2), pairs[letter[:, None], letter], flat)
    first, law = _FIRST[kind] * flat, _TURNS[kind[:, None], kind] * after
    return first / first.sum(), law / law.sum(1, keepdims=True)


def encoding(run: bytes) -> bytes | None:
    """The alphabet of the smallest encoding that fits; None for runs without letters."""
    have = set(run.rstrip(b"="))
    digits = any(0x30 <= c <= 0x39 for c in have)
    if not any(c >= 0x41 and c != 0x5F for c in have):
        return None
    for alphabet, needs_digit in ENCODINGS:
        if have <= set(alphabet) and (digits or not needs_digit):
            return alphabet
    return None


def _classes(alphabet: bytes) -> np.ndarray:
    kind = _kinds(alphabet)
    return 4 + np.isin(list(alphabet.lower()), list(b"aeiouy")) if len(set(kind.tolist())) == 1 else kind


def statistics(places: np.ndarray, alphabet: bytes) -> np.ndarray:
    """Of runs of one length, a row of places in the alphabet each: chi-squared (both cases of a letter are one
    cell, as a short run fills few), runs of a class, serial correlation of places, and of vowels (1) with
    other letters (-1) and the rest (0)."""
    rows, n = places.shape
    _, cell, width = np.unique(list(alphabet.lower()), return_inverse=True, return_counts=True)
    counts = np.bincount((cell[places] + len(width) * np.arange(rows)[:, None]).ravel(),
                         minlength=rows * len(width)).reshape(rows, -1)
    expected = n * width / len(alphabet)
    chi = ((counts - expected) ** 2 / expected).sum(1)
    kind = _classes(alphabet)[places]
    before, after = kind[:, :-1], kind[:, 1:]
    changes = ((before != after) & (before != 3) & ~((before == 1) & (after == 0))).sum(1)
    off = places - places.mean(1, keepdims=True)
    square = (off * off).sum(1)
    serial = np.where(square > 0, (off[:, 1:] * off[:, :-1]).sum(1) / np.where(square > 0, square, 1), 1.0)
    sound = _sounds(alphabet)[places]
    return np.stack([chi, changes, serial, (sound[:, 1:] * sound[:, :-1]).mean(1)], axis=1)


def _sounds(alphabet: bytes) -> np.ndarray:
    return np.array([1 if c in b"aeiouy" else -1 if 0x61 <= c <= 0x7A else 0 for c in alphabet.lower()])


def _draws(alphabet: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``BLOCK`` places: of equal shares, and as ordinary text goes. Their beginnings are shorter runs."""
    if alphabet not in _drawn:
        rng, size = np.random.default_rng(8), len(alphabet)
        equal = rng.integers(0, size, (DRAWS, BLOCK))
        text = np.empty((DRAWS, BLOCK), np.int64)
        first, law = (x.cumsum(-1) for x in _text_law(alphabet))
        text[:, 0] = np.minimum(np.searchsorted(first, rng.random(DRAWS)), size - 1)
        for k in range(1, BLOCK):
            text[:, k] = np.minimum((law[text[:, k - 1]] < rng.random(DRAWS)[:, None]).sum(1), size - 1)
        _drawn[alphabet] = equal, text
    return _drawn[alphabet]


class Spread(NamedTuple):
    """Of the statistics at one length: means and deviations of either kind, and moments of Fisher's sum."""

    equal: np.ndarray
    equal_by: np.ndarray
    text: np.ndarray
    text_by: np.ndarray
    side: np.ndarray  # where equal shares lie as seen from text
    mean: float
    variance: float


def spread(alphabet: bytes, n: int) -> Spread:
    if (alphabet, n) not in _spreads:
        equal, text = (statistics(places[:, :n], alphabet) for places in _draws(alphabet))
        text_by = np.maximum(text.std(0), 1e-9)
        side = np.sign(equal.mean(0) - text.mean(0))
        sums = _fisher((text - text.mean(0)) / text_by * side)
        _spreads[alphabet, n] = Spread(equal.mean(0), np.maximum(equal.std(0), 1e-9), text.mean(0), text_by, side,
                                       float(sums.mean()), float(sums.var()))
    return _spreads[alphabet, n]


def _log_tail(z: float) -> float:
    """The log of the normal distribution's upper tail."""
    if z < 30:
        return math.log(0.5 * math.erfc(z / math.sqrt(2)))
    return -z * z / 2 - math.log(z * math.sqrt(2 * math.pi))


def _fisher(deviations: np.ndarray) -> np.ndarray:
    """-2 times the sum of the log p-values of each row of deviations."""
    return np.array([-2 * sum(map(_log_tail, row)) for row in deviations.tolist()])


def battery(run: bytes) -> tuple[np.ndarray, np.ndarray, float] | None:
    """(deviations from equal shares, deviations from text towards them, p) of a run; None without an encoding.

    A sum of Fisher's is taken as a multiple of a chi-squared variable with the measured
    mean and variance, its tail by the cube root's normal law.
    """
    alphabet, body = encoding(run), run.rstrip(b"=")
    if alphabet is None or len(body) < LEAST["random"]:
        return None
    lookup = np.zeros(256, np.int64)
    lookup[list(alphabet)] = np.arange(len(alphabet))
    blocks = np.array_split(lookup[np.frombuffer(body, np.uint8)], -(-len(body) // BLOCK))
    off, toward = np.zeros(4), np.zeros(4)
    for block in blocks:
        own, law = statistics(block[None], alphabet)[0], spread(alphabet, len(block))
        off += (own - law.equal) / law.equal_by
        toward += (own - law.text) / law.text_by * law.side
    off, toward = off / math.sqrt(len(blocks)), toward / math.sqrt(len(blocks))
    law = spread(alphabet, len(blocks[0]))
    scale, freedom = law.variance / (2 * law.mean), 2 * law.mean ** 2 / law.variance
    root = (float(_fisher(toward[None])[0]) / (scale * freedom)) ** (1 / 3)
    by = 2 / (9 * freedom)
    return off, toward, math.exp(max(-690.0, _log_tail((root - 1 + by) / math.sqrt(by))))


def ordinary(run: bytes) -> float:
    """How likely ordinary text looks as random as this run; 1 if it fits no encoding or is not random."""
    tested = battery(run)
    if tested is None or np.abs(tested[0]).max() > APART:
        return 1.0
    return tested[2]


def parts(run: bytes) -> list[tuple[int, int, float]]:
    """(start, end, p) of the parts of a run that are tested; all count where the share of false ones is held.

    The run is taken whole, or cut at ``-_``, at ``+/`` or at all four signs, whichever way gives
    the strongest evidence; each p-value is multiplied by the number of ways that differ.
    """
    ways = {tuple(m.span() for m in way.finditer(run) if m.end() - m.start() >= LEAST["random"]) for way in _WAYS}
    ways.discard(())
    best: list[tuple[int, int, float]] = []
    for way in sorted(ways):
        own = [(s, e, min(1.0, ordinary(run[s:e]) * len(ways))) for s, e in way]
        if not best or min(p for *_, p in own) < min(p for *_, p in best):
            best = own
    return [(s, e, p) for s, e, p in best if encoding(run[s:e])]


def padded(data: bytes, end: int, last: int) -> int:
    """Where a run ends with its padding: at most two ``=`` that no further sign of a run or ``=`` follows."""
    to = end
    while to < last and data[to] == 0x3D:
        to += 1
    return to if to - end <= 2 and not (to < last and _RUN[data[to]]) else end


def _found(part: pa.RecordBatch) -> tuple[list[list], list[list]]:
    """For each text its (start, kind, end) by pattern, and its (start, end, class, step) to be judged."""
    texts = part.column("text")
    data, at = text_bytes(texts)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    base = points[at]
    spans: list[list] = [[] for _ in range(len(texts))]
    runs: list[list] = [[] for _ in range(len(texts))]
    whole = data.tobytes()
    bounds = at.tolist()
    for k in range(len(texts)):
        low = whole[bounds[k]:bounds[k + 1]]
        for match in _ACCESS.finditer(low):
            if match.end() - match.start() >= LEAST["access"]:
                spans[k].append((match.start(), 1, match.end()))
        small = low.lower()
        if any(name in small for name in _NAMES):
            for match in _ASSIGN.finditer(low):
                if len(match[2]) >= LEAST["assign"]:
                    spans[k].append((match.start(), 0, match.end()))
        spans[k] = [(int(points[bounds[k] + s] - base[k]), kind, int(points[bounds[k] + e] - base[k]))
                    for s, kind, e in spans[k]]
    for inside, least, kind in ((_HEX, LEAST["hex"], 2), (_RUN, LEAST["random"], 3)):
        starts, ends, _ = word_bounds(data, at, inside)
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        owner = np.searchsorted(at, starts, "right") - 1
        for k, s, e in zip(owner.tolist(), starts.tolist(), ends.tolist()):
            span = int(points[s] - base[k]), int(points[e] - base[k])
            if kind == 2:
                spans[k].append((span[0], kind, span[1]))
            else:
                for from_, to, p in parts(whole[s:padded(whole, e, bounds[k + 1])]):
                    step = min(_STEPS, int(-math.log(max(p, 1e-300)) / _STEP))
                    runs[k].append((span[0] + from_, span[0] + to, (to - from_).bit_length(), step))
    return [sorted(s) for s in spans], runs


_SPAN = "struct<start:int,kind:int,end:int>"
_JUDGED = "struct<start:int,end:int,class:int,step:int>"


def _scan(batches, schema: pa.Schema):
    for batch in batches:
        for part in slices(batch):
            spans, runs = _found(part)
            yield batch_of(
                schema, part.column("doc_id"),
                [[dict(zip(("start", "kind", "end"), s)) for s in own] for own in spans],
                [[dict(zip(("start", "end", "class", "step"), s)) for s in own] for own in runs],
            )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, runs): spans by pattern, and runs with length class and evidence."""
    schema = pa.schema([
        ("doc_id", pa.int64()),
        ("base", pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")]))),
        ("runs", pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "end", "class", "step")]))),
    ])
    return docs.select(F.col("doc_id").cast("long"), as_text()).mapInArrow(
        lambda batches: _scan(batches, schema), f"doc_id long, base array<{_SPAN}>, runs array<{_JUDGED}>")


def thresholds(scanned: DataFrame, false_share: float = FALSE_SHARE) -> dict[int, int]:
    """Per length class the least step of evidence at which runs are reported.

    One count per class and step comes to the driver: some thirty classes of 241 steps.
    """
    counts = scanned.select(F.inline("runs")).groupBy("class", "step").count().collect()
    least = {}
    for cls in {r["class"] for r in counts}:
        held = {r["step"]: r["count"] for r in counts if r["class"] == cls}
        total, above = sum(held.values()), 0
        for step in sorted(held, reverse=True):
            above += held[step]
            if math.exp(-_STEP * step) * total <= false_share * above:
                least[cls] = step
    return least


def secrets(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every document."""
    scanned = stage(scan(docs), "scanned")
    judged = scanned.select("doc_id", "base", _reported(thresholds(scanned, false_share)).alias("added"))

    def text(spans):
        kinds = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def held(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return judged.select(
        "doc_id", *[held(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(text(F.col("base")), 256).alias("base_sha256"),
        text(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def _reported(least: dict[int, int]):
    """The runs that reach their class's threshold, as spans."""
    pairs = [F.lit(x) for cls, step in sorted(least.items()) for x in (cls, step)]
    bound = F.create_map(*pairs) if pairs else F.lit(None).cast("map<int,int>")
    kept = F.filter("runs", lambda r: F.coalesce(r["step"] >= F.try_element_at(bound, r["class"]), F.lit(False)))
    return F.transform(kept, lambda r: F.struct(
        r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))


def _redact(batches, least: dict[int, int], mask: str):
    for batch in batches:
        for part in slices(batch):
            spans, runs = _found(part)
            texts = part.column("text").to_pylist()
            for k, text in enumerate(texts):
                cut = [(s, e) for s, _, e in spans[k]]
                cut += [(s, e) for s, e, cls, step in runs[k] if step >= least.get(cls, _STEPS + 1)]
                if cut:
                    out, at = [], 0
                    for s, e in sorted(cut):
                        if s > at or not out:
                            out += [text[at:s], mask]
                        at = max(at, e)
                    texts[k] = "".join([*out, text[at:]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == "text" else part.column(n) for n in part.schema.names],
                names=part.schema.names)


def redacted(docs: DataFrame, false_share: float = FALSE_SHARE, mask: str = "[secret]") -> DataFrame:
    """The documents, in their own columns, with ``mask`` in place of every span."""
    least = thresholds(scan(docs), false_share)
    return docs.withColumn("text", as_text()).mapInArrow(
        lambda batches: _redact(batches, least, mask), docs.schema)
