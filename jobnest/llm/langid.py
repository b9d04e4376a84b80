"""Language identification by rank-order profiles.

A text's n-grams (1 to 3 letters of its lower-cased words, each word with a blank on either side) are ranked by
frequency.  A language's profile is the ``PROFILE`` most frequent n-grams of its training texts.  A text belongs to the
language with the smallest out-of-place distance: over its own ``PROFILE`` most frequent n-grams, the sum of rank
differences, or ``PROFILE`` where the profile lacks the n-gram.  Ties in frequency go to the smaller n-gram, ties in
distance to the smaller language name.

Profiles are fitted on a bounded sample: of each language the labelled rows with the ``TRAIN_ROWS`` smallest keyed hashes
of their ids, so that every language has a profile however rare it is.
``score`` is 1 - distance / largest possible distance.  A null text, one without letters, and any text where nothing
was learned is ``und`` with score 0.  Repeated rows are judged one by one; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import at_work, flat, map_batches, pick, place, short_batches

#: Texts of a batch that are Python strings at a time.
TEXTS_AT_ONCE = 64
PROFILE = 300
#: Bound of the training sample of each language.
TRAIN_ROWS = 20_000
UNKNOWN = "und"
#: The pipeline rejects a text whose best distance is this share of the largest one.
REJECT_SCORE = 0.05

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams as integers of three 21-bit code points (blank: 1, none: 0) and their counts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _is_letter()[points]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.concatenate(([1], np.where(letter, points, 1), [1]))
    keep = np.concatenate(([True], (points[1:] != 1) | (points[:-1] != 1)))
    c = points[keep]
    one = c[c != 1]
    two = c[:-1] << 21 | c[1:]
    # a blank may begin or end three characters, not stand between them
    three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[c[1:-1] != 1]
    return np.unique(np.concatenate((one, two, three)), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, by frequency, then n-gram (``grams`` is sorted)."""
    if len(grams) > most:
        least = np.partition(counts, len(counts) - most)[-most]
        some = np.flatnonzero(counts >= least)
        grams, counts = grams[some], counts[some]
    return grams[np.argsort(-counts, kind="stable")[:most]]


def train(docs: DataFrame, usable: Column, most_rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Profiles by language from the rows of ``docs`` (doc_id, text, lang) that satisfy ``usable``.

    The driver gets PROFILE n-grams for every language."""
    rows = pick(docs, doc_id="long", text="string", lang="string").filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    key = F.xxhash64("doc_id", F.lit(11))
    keys = rows.select("lang", key.alias("h"))
    # a window over a language's keys below twice the share that is needed
    sizes = keys.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    near = F.when(F.col("n") > 2 * most_rows, ((F.lit(2.0 * most_rows) / F.col("n") - 0.5) * 2.0**64).cast("long")).otherwise(2**63 - 1)
    near = keys.join(F.broadcast(sizes.select("lang", near.alias("near"))), "lang").filter("h <= near").select("lang", "h").distinct()
    first = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("h"))).filter(F.col("rank") <= most_rows)
    last = first.groupBy("lang").agg(F.max("h").alias("last"))

    def count(batch):
        total: dict[str, dict[int, int]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            mine = total.setdefault(lang, {})
            for g, n in zip(*[a.tolist() for a in ngrams(text)]):
                mine[g] = mine.get(g, 0) + n
        return {"lang": [k for k, v in total.items() for _ in v], "gram": [g for v in total.values() for g in v], "n": [n for v in total.values() for n in v.values()]}

    grams = map_batches(rows.join(F.broadcast(last), "lang").filter(key <= F.col("last")).select("text", "lang"), count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = grams.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("rank") <= PROFILE)
    profiles: dict[str, list] = {}
    for lang, gram, rank in best.select("lang", "gram", "rank").collect():
        profiles.setdefault(lang, []).append((rank, gram))
    return {lang: np.array([g for _, g in sorted(profiles[lang])], dtype=np.int64) for lang in sorted(profiles)}


class Judge:
    def __init__(self, profiles: dict[str, np.ndarray]):
        self.langs = list(profiles)
        self.sorted = []
        for p in profiles.values():
            order = np.argsort(p)
            self.sorted.append((p[order], order))

    def __call__(self, text: str | None) -> tuple[str, float]:
        own = ranked(*ngrams(text)) if text and self.langs else ()
        if not len(own):
            return UNKNOWN, 0.0
        ranks = np.arange(len(own))
        distances = []
        for grams, places in self.sorted:
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            distances.append(int(np.where(grams[at] == own, np.abs(places[at] - ranks), PROFILE).sum()))
        best = int(np.argmin(distances))
        return self.langs[best], 1 - distances[best] / (PROFILE * len(own))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text)."""

    def judge(batch):
        one = Judge(profiles)
        got = [one(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return map_batches(pick(docs, doc_id="long", text="string"), judge, "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the texts that are ``und`` or that no learned profile resembles; columns unchanged."""
    profiles = train(docs, ~held_out(F.col("doc_id")))

    def keep(texts):
        import pyarrow as pa

        at_work(__name__)
        one = Judge(profiles)
        good = []
        for begin in range(0, len(texts), TEXTS_AT_ONCE):
            for t in texts.slice(begin, TEXTS_AT_ONCE).to_pylist():
                lang, score = one(t)
                good.append(lang != UNKNOWN and score >= REJECT_SCORE)
        return pa.array(good, pa.bool_())

    # the texts alone go to Python; the rows stay in the JVM
    rows = short_batches(flat(docs))
    return rows.filter(F.arrow_udf(keep, "boolean")(F.col(f"c{place(docs, 'text')}").cast("string"))).toDF(*docs.columns)
