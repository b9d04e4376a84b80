"""Secret scan: pattern matches, and strings that a character Markov model takes for random.

Two first-order models over the characters of keys are trained from labelled samples: *random* from the values that the
patterns find in the corpus and from seeded random strings over the usual alphabets, *ordinary* from all other runs of
those characters in the corpus.  A run of ``MIN_RUN`` characters or more that touches no pattern match is a secret if
its log-likelihood ratio (random against ordinary) reaches ``MIN_TOTAL`` nats and ``MIN_MEAN`` nats a character.

A null or empty text has no spans.  Repeated rows are scanned one by one; an empty table trains on the seeded strings
alone and gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat, map_batches, pick, place

KINDS = ("assign", "access", "hex", "markov")
_KEYWORDS = "password", "passwd", "secret", "token", "api_?key"
_EITHER = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k) for k in _KEYWORDS)
ASSIGN = re.compile(rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of hex digits is always matched whole
MIN_ASSIGN, MIN_ACCESS = 6, 20

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABET = LOWER + UPPER + DIGITS + "+/_-="
N = len(ALPHABET)
#: Alphabets of the seeded random strings: hex, upper-case keys, base 62, base 64, URL-safe base 64.
SEEDED = (DIGITS + "abcdef", UPPER + DIGITS, LOWER + UPPER + DIGITS, LOWER + UPPER + DIGITS + "+/", LOWER + UPPER + DIGITS + "_-")
SEEDED_STRINGS, SEEDED_LENGTH, SEED = 400, 40, 17
MIN_RUN, MIN_TOTAL, MIN_MEAN = 16, 14.0, 0.6

_SYMBOL = np.full(129, N, dtype=np.int64)
_SYMBOL[[ord(c) for c in ALPHABET]] = np.arange(N)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the pattern matches in code points, by start and kind."""
    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def _symbols(text: str) -> np.ndarray:
    """The alphabet's index of every code point; N for any other."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _SYMBOL[np.minimum(points, 128)]


def _transitions(symbols: np.ndarray) -> np.ndarray:
    """Counts of (previous or N at a run's start, symbol)."""
    before = np.concatenate(([N], symbols[:-1]))
    inside = symbols < N
    return np.bincount(before[inside] * N + symbols[inside], minlength=(N + 1) * N)


def _seeded() -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(SEED))
    total = np.zeros((N + 1) * N, dtype=np.int64)
    for letters in SEEDED:
        codes = np.array([ALPHABET.index(c) for c in letters])
        for _ in range(SEEDED_STRINGS):
            total += _transitions(codes[rng.integers(0, len(codes), SEEDED_LENGTH)])
    return total


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratios [(previous, symbol)] from every text of the corpus.

    Each batch gives its summed transition counts; at most 2 * 68 * 67 sums reach the driver, whatever the input."""

    def count(batch):
        ordinary, random = np.zeros((2, (N + 1) * N), dtype=np.int64)
        for text in batch.column(0).to_pylist():
            if text:
                symbols = _symbols(text)
                for start, end, kind in base_spans(text):
                    if kind == 0:
                        start += ASSIGN.match(text, start).start(2) - start
                    random += _transitions(symbols[start:end])
                    symbols[start:end] = N
                ordinary += _transitions(symbols)
        both = np.concatenate((ordinary, random))
        seen = np.flatnonzero(both)
        return {"cell": seen, "n": both[seen]} if len(seen) else None

    cells = map_batches(pick(docs, text="string").filter("text <> ''"), count, "cell int, n long")
    sums = np.zeros(2 * (N + 1) * N)
    for cell, n in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        sums[cell] = n
    ordinary, random = sums.reshape(2, N + 1, N)
    random = random + _seeded().reshape(N + 1, N)

    def logs(counts):
        # every transition gets half a count, so that an unseen one stays possible
        return np.log((counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True))

    return logs(random) - logs(ordinary)


def model_spans(text: str, ratio: np.ndarray, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs that the models take for random strings and that touch no span in ``taken``."""
    symbols = _symbols(text)
    inside = np.concatenate(([False], symbols < N, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= MIN_RUN
    found = []
    for start, end in zip(starts[long].tolist(), ends[long].tolist()):
        if any(start < e and s < end for s, e, _ in taken):
            continue
        run = symbols[start:end]
        score = ratio[np.concatenate(([N], run[:-1])), run].sum()
        if score >= MIN_TOTAL and score >= MIN_MEAN * (end - start):
            found.append((start, end, 3))
    return found


def scan(docs: DataFrame, ratio: np.ndarray | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and its spans, an array of (kind, start, end) by start, then kind."""
    ratio = train(docs) if ratio is None else ratio

    def find(batch):
        out = []
        for text in batch.column(1).to_pylist():
            base = base_spans(text or "")
            spans = sorted(base + model_spans(text, ratio, base), key=lambda s: (s[0], s[2])) if text else []
            out.append([{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans])
        return {"doc_id": batch.column(0), "spans": out}

    return map_batches(pick(docs, doc_id="long", text="string"), find, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def digests(scanned: DataFrame) -> DataFrame:
    """The contract's columns of ``scan``'s rows."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    base = F.filter("spans", lambda s: s.kind != "markov")
    return scanned.select("doc_id", *[of(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` (overlapping spans by one) and n_chars, where there is
    such a column, set to the new length.  Null texts stay null."""
    ratio = train(docs)
    names = docs.columns
    at = place(docs, "text")

    def clean(batch):
        texts = []
        for text in batch.column(at).to_pylist():
            if text:
                base = base_spans(text)
                parts, end = [], 0
                for s, e, _ in sorted(base + model_spans(text, ratio, base)):
                    if s >= end:
                        parts += [text[end:s], mark]
                    end = max(end, e)
                text = "".join(parts) + text[end:]
            texts.append(text)
        cols = {i: batch.column(i) for i in range(len(names))} | {at: texts}
        if "n_chars" in names:
            cols[names.index("n_chars")] = [None if t is None else len(t) for t in texts]
        return cols

    return map_batches(flat(docs), clean, flat(docs).schema).toDF(*names)


def hashed(spans: list[tuple[int, int, int]]) -> str:
    """The digest of spans, for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
