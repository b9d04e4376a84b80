"""Substring deduplication by winnowed windows and exact extension.

A hash rolls over a text's UTF-8 bytes, ``WINDOW`` at a time; of every ``STEP`` windows in a row the smallest hash stands
for the text.  What is chosen depends on the bytes there alone, so two texts that share ``WINDOW + STEP - 1`` bytes (51
words have as many) share a hash, wherever those bytes lie.  A hash of two documents or more proposes each of them with
the first that has it.  A pair's texts are then compared byte by byte: where they share a window the match is extended to
both sides as far as the texts agree, and cut back to whole words.  Matches of ``MIN_WORDS`` words or more are repeated
passages, so that passages of over 50 words are found whole while lines of a few words are left alone.

Every row names one pair: the passage as its first document has it.  A document may have passages that overlap, with one
first document or several; a first document has a row, named after itself, for each of its passages that a later one
has.  A document is compared with the first document of each of its hashes, not with all that have it.  Null and empty
texts have no passages.  Copies are passages of whole texts.  Rows that repeat an id are one document.  An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import counted, flat, frequent, likely, map_batches, mixed, pick, place, written

WINDOW, STEP = 48, 54
MIN_WORDS = 20


def _gear() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(8)).integers(0, 2**64, 256, dtype=np.uint64)


_GEAR = _gear()
_BASE = 0x9E3779B97F4A7C15
_SPACE = b" \t\n\x0b\x0c\r"


def hashes(data: np.ndarray) -> np.ndarray:
    """Of each window its hash: the sum of gear[byte] times a power of the base, built by doubling the window.  A text of
    less than a window has one, of all its bytes."""
    h, whole, width, done = _GEAR[data], np.zeros(len(data), np.uint64), 1, 0
    while width <= WINDOW:
        if WINDOW & width:
            whole[done:] += h[:max(0, len(h) - done)] * np.uint64(pow(_BASE, done, 2**64))
            done += width
        h[width:] += h[:-width] * np.uint64(pow(_BASE, width, 2**64))
        width *= 2
    return mixed(whole[min(WINDOW, len(whole)) - 1:])


def _slide(least, h: np.ndarray, n: int) -> np.ndarray:
    """``least`` of every ``n`` values in a row."""
    width = 1
    while width < n:
        by = min(width, n - width)
        h = least(h[:-by], h[by:])
        width += by
    return h


def chosen(h: np.ndarray) -> np.ndarray:
    """The places of the smallest of every ``STEP`` hashes in a row."""
    n = min(STEP, len(h))
    least = _slide(np.minimum, h, n)
    # the largest of the minima of the runs that a hash is in
    edge = np.zeros(n - 1, np.uint64)
    return np.flatnonzero(_slide(np.maximum, np.concatenate([edge, least, edge]), n) == h)


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the windows that stand for a text's bytes."""
    return chosen(hashes(data)) + min(WINDOW, len(data))


def digests(docs: DataFrame) -> DataFrame:
    """(digest, doc_id): the hashes that stand for every document."""

    def cut(batch):
        import pyarrow as pa

        digest, owner = [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            h = hashes(np.frombuffer(text, np.uint8))
            digest.append(np.unique(h[chosen(h)]).view(np.int64))
            owner.append(np.full(len(digest[-1]), doc_id))
        return {"digest": np.concatenate(digest), "doc_id": np.concatenate(owner)} if digest else None

    return map_batches(docs, cut, "digest long, doc_id long")


def several(own: DataFrame) -> DataFrame:
    """(key): the counted bits of the digests that more than one row of (doc_id, text) has, and of few others."""

    def numbers(batch):
        import pyarrow as pa

        for text in batch.column(0).cast(pa.binary()).to_pylist():
            h = hashes(np.frombuffer(text, np.uint8))
            yield np.unique(h[chosen(h)])

    return frequent(own.select("text"), numbers, 1)


class Matcher:
    """The passages that texts share with this one."""

    def __init__(self, text: bytes):
        self.text, self.back = text, text[::-1]
        h = hashes(np.frombuffer(text, np.uint8))
        self.places = chosen(h)
        self.found = h[self.places]
        order = np.argsort(self.found, kind="stable")
        self.at, self.hash = self.places[order], self.found[order]

    def __call__(self, other: bytes | Matcher, min_words: int) -> list[tuple[int, int, int, int]]:
        """(start, end, first_start, n_words) of every match of ``min_words`` words that is as long as it can be."""
        text = other if isinstance(other, bytes) else other.text
        if text == self.text:
            n = len(text.split())
            return [(0, len(text), 0, n)] if n >= min_words else []
        if min(len(text), len(self.text)) < WINDOW:
            return []
        if isinstance(other, bytes):
            other = Matcher(other)
        at, back = other.places, other.back
        lo, hi = (np.searchsorted(self.hash, other.found, side) for side in ("left", "right"))
        some = np.flatnonzero(hi > lo)
        out, done = [], 0
        for i, x, y in zip(at[some].tolist(), lo[some].tolist(), hi[some].tolist()):
            # a window inside the match before belongs to it
            if i + WINDOW <= done:
                continue
            best = (0, 0, 0)
            for j in self.at[x:y].tolist():
                ahead = _agree(text, i, self.text, j)
                if ahead >= WINDOW:
                    behind = _agree(back, len(text) - i, self.back, len(self.text) - j)
                    best = max(best, (behind + ahead, i - behind, j - behind))
                    if i + ahead == len(text) and i == behind:
                        break
            size, start, first = best
            if size:
                done = start + size
                a, b = self._words(text, start, done, first)
                n = len(text[a:b].split())
                if n >= min_words:
                    out.append((a, b, first + a - start, n))
        return out

    def _words(self, text: bytes, start: int, end: int, first: int) -> tuple[int, int]:
        """The part of a match that is whole words of both texts, and all white space at the ends that both begin or end with."""
        cut = lambda t, i: 0 < i < len(t) and t[i - 1] not in _SPACE and t[i] not in _SPACE
        a, b, last = start, end, first + end - start
        if cut(text, a) or cut(self.text, first):
            while a < b and text[a] not in _SPACE:
                a += 1
        if cut(text, b) or cut(self.text, last):
            while a < b and text[b - 1] not in _SPACE:
                b -= 1
        if start or first:
            a = b - len(text[a:b].lstrip(_SPACE))
        if end < len(text) or last < len(self.text):
            b = a + len(text[a:b].rstrip(_SPACE))
        return a, b


def _agree(a: bytes, i: int, b: bytes, j: int) -> int:
    """How many bytes are equal from ``i`` and ``j`` on."""
    n, at, step = min(len(a) - i, len(b) - j), 0, 64
    while at < n:
        m = min(step, n - at)
        if a[i + at: i + at + m] != b[j + at: j + at + m]:
            return at + int((np.frombuffer(a, np.uint8, m, i + at) != np.frombuffer(b, np.uint8, m, j + at)).argmax())
        at, step = at + m, step * 2
    return n


def repeated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start, end, n_words, first_doc_id) of every passage (bytes of the text) that another document has too.

    Only digests that may repeat are shuffled, counted with map-side sums and joined back to; of a pair the shorter text goes
    to the longer one.  The joins are ones that Spark can split by size."""
    own = pick(docs, doc_id="long", text="string").filter("doc_id is not null and text <> ''")
    keyed = digests(own).withColumn("key", counted("digest"))
    all_ = written(likely(keyed, "key", written(several(own), "several")).select("digest", "doc_id"), "digests")
    twice = all_.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("_last")).filter("first_doc_id < _last").select("digest", "first_doc_id")
    pairs = written(all_.join(twice, "digest").filter("first_doc_id < doc_id").select("doc_id", "first_doc_id").distinct(), "pairs")
    involved = written(pairs.select("doc_id").union(pairs.select("first_doc_id")).distinct().withColumn("key", F.xxhash64("doc_id")), "involved")
    wanted = likely(own.withColumn("key", F.xxhash64("doc_id")), "key", involved.select("key")).drop("key")
    # rows that repeat an id and its text would meet each other's
    texts = wanted.join(involved.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    sizes = wanted.groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("size"))
    for x in ("doc_id", "first_doc_id"):
        pairs = pairs.join(sizes.select(F.col("doc_id").alias(x), F.col("size").alias(f"_{x}")), x)
    longer = F.col("_doc_id") > F.col("_first_doc_id")
    pairs = pairs.select(F.when(longer, F.col("doc_id")).otherwise(F.col("first_doc_id")).alias("stays"),
                         F.when(longer, F.col("first_doc_id")).otherwise(F.col("doc_id")).alias("goes"))
    gone = pairs.join(texts.select(F.col("doc_id").alias("goes"), F.col("text").alias("goes_text")), "goes")
    both = gone.join(texts.select(F.col("doc_id").alias("stays"), F.col("text").alias("stays_text")), "stays")

    def match(batch):
        import pyarrow as pa

        out = {k: [] for k in ("doc_id", "start", "end", "n_words", "first_doc_id")}
        there = None
        for stays, goes, stays_text, goes_text in zip(*(batch.column(i).to_pylist() for i in range(2)), *(batch.column(i).cast(pa.binary()).to_pylist() for i in (2, 3))):
            if there is None or there.text != stays_text:
                there = Matcher(stays_text)
            doc_id, first = max(stays, goes), min(stays, goes)
            matches = there(goes_text, min_words) if stays == first else Matcher(goes_text)(there, min_words)
            for start, end, at, n in matches:
                for row in ((doc_id, start, end, n, first), (first, at, at + end - start, n, first)):
                    for k, v in zip(out, row):
                        out[k].append(v)
        return out

    schema = "doc_id long, start long, end long, n_words long, first_doc_id long"
    return map_batches(both.select("stays", "goes", "stays_text", "goes_text"), match, schema).distinct()


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated passages cut out of every document but the first that has them; columns unchanged.

    A passage of a pair is cut whatever larger repeat it lies in."""
    names = docs.columns
    spans = repeated(docs, min_words).filter("first_doc_id < doc_id").groupBy(F.col("doc_id").alias("_id")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    own = flat(docs)
    at = place(docs, "text")
    rows = own.join(spans, F.col(f"c{place(docs, 'doc_id')}").cast("long") == F.col("_id"), "left").drop("_id")

    def cut(batch):
        texts = []
        for text, spans_ in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
            if text and spans_:
                data, parts, done = text.encode(), [], 0
                for s in spans_:
                    parts.append(data[done:max(done, s["start"])])
                    done = max(done, s["end"])
                text = b"".join([*parts, data[done:]]).decode("utf-8", "ignore")
            texts.append(text)
        cols = {i: batch.column(i) for i in range(len(names))} | {at: texts}
        if "n_chars" in names:
            cols[names.index("n_chars")] = [None if t is None else len(t) for t in texts]
        return cols

    return map_batches(rows, cut, own.schema).toDF(*names)
