"""Mixing sources to target weights.

The words of a source, its documents one after the other, are packed into blocks of ``BLOCK`` words.  A source's target
is its weight's share of the mix, at most ``MOST_PASSES`` times its size, the excess reshared by weight.  Its slots (one
block each; the last one is cut to the target) are dealt over the output shards by one multinomial draw, which gives
every shard its counts by source.  The k-th slot of a source reads block ``permutation(k)`` of pass ``k // blocks``, a
keyed permutation of the block numbers, so no block comes twice in a pass; blocks are joined by source and number.

All draws are keyed by ``seed``, so reruns agree; documents with the same id are ordered by a hash of their text.  A null text has size 0; a null source is a source of its own, the
last one; repeated rows count as documents of their own; an empty table gives no rows.  Very long texts are packed whole,
over as many blocks as they need; other columns are carried by position, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, flat, map_batches, mixed, place, written
from .ordering import running

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_PASSES = 2
BLOCK = 64
#: Slots of an output shard, on average, and of a task that makes slots.
SHARD_SLOTS, TASK_SLOTS = 8192, 1 << 17
SEED = 23


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size) with ``target`` in words, one row per source.

    Sources by ratio of cap to weight: the first ones fill up, the others get the rest by weight; one sorted pass finds
    the place where that changes.  The table has one row per source, each with a weight of its own."""
    everything = W.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1
    picked = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", picked).withColumn("cap", F.lit(float(MOST_PASSES)) * F.col("source_size"))
    s = s.withColumn("all", F.sum("source_size").over(everything) * F.lit(float(share)))
    up = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, W.currentRow)
    # were this source and those with smaller ratios full, the rest would have this level (words for a unit of weight)
    # were the sources before this one full, it and those after it would share at this level (words for a unit of weight)
    left = F.sum("weight").over(everything) - F.sum("weight").over(up) + F.col("weight")
    s = s.withColumn("level", (F.col("all") - F.sum("cap").over(up) + F.col("cap")) / left)
    s = s.withColumn("is_full", F.col("level") * F.col("weight") >= F.col("cap"))
    final = F.min(F.when(~F.col("is_full"), F.struct((F.col("cap") / F.col("weight")).alias("ratio"), "level"))).over(everything)
    s = s.withColumn("final", final)
    return s.select("source", "source_size", F.when(F.col("is_full"), F.col("cap")).otherwise(F.col("final.level") * F.col("weight")).alias("target"))


def _key(source: str | None, seed: int) -> int:
    return (zlib.crc32(b"\0" if source is None else source.encode()) << 16 ^ seed) & 0x7FFFFFFF


def permutation(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of range(n) at ``index``: four Feistel rounds over the next power of four, walked until
    inside; on average under four walks."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x):
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            left, right = right, left ^ (mixed(right, key * 4 + r) & mask)
        return left << np.uint64(half) | right

    x = once(index.astype(np.uint64))
    while (out := x >= n).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


def shard_counts(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, n_words, blocks, rest, shard, first, n): how many slots a shard takes of a source, and the number of its
    first slot.  ``sources``: source, n_words (of the source), slots, last (words of the last slot)."""

    def draw(batch):
        rows = {k: [] for k in ("source", "n_words", "slots", "last", "shard", "first", "n")}
        for r in batch.to_pylist():
            rng = np.random.Generator(np.random.PCG64([_key(r["source"], seed), 1]))
            n = rng.multinomial(r["slots"], np.full(shards, 1 / shards))
            first = np.cumsum(n) - n
            some = np.flatnonzero(n)
            for k in ("source", "n_words", "slots", "last"):
                rows[k] += [r[k]] * len(some)
            rows["shard"] += some.tolist()
            rows["first"] += first[some].tolist()
            rows["n"] += n[some].tolist()
        return rows

    return map_batches(sources, draw, "source string, n_words long, slots long, last long, shard long, first long, n long")


def slots(counts: DataFrame, block: int, seed: int) -> DataFrame:
    """Every slot: (source, block, shard, cut): the block it reads and the words of it that it takes."""

    def fill(batch):
        out = {k: [] for k in ("source", "block", "shard", "cut")}
        for r in batch.to_pylist():
            blocks = -(-r["n_words"] // block)
            k = np.arange(r["first"], r["first"] + r["n"])
            number = np.empty(len(k), dtype=np.int64)
            for turn in np.unique(k // blocks).tolist():
                now = k // blocks == turn
                number[now] = permutation(k[now] % blocks, blocks, _key(r["source"], seed) * MOST_PASSES + turn)
            cut = np.full(len(k), block)
            cut[k == r["slots"] - 1] = r["last"]
            out["source"] += [r["source"]] * len(k)
            out["shard"] += [r["shard"]] * len(k)
            out["block"] += number.tolist()
            out["cut"] += cut.tolist()
        return out

    return map_batches(counts, fill, "source string, block long, shard long, cut long")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces).  documents: doc_id, source, size, source_size, target, taken, _row.
    pieces: _row, shard, block, start, end: the words [start, end) of a document that a slot takes."""
    placed, pieces, quota = _mixed(docs, weights, share, block, seed)
    taken = pieces.groupBy("_row").agg(F.sum(F.col("end") - F.col("start")).alias("taken"))
    known = quota.select(F.col("source").alias("_s"), "source_size", "target")
    known = F.broadcast(known) if _small(quota) else known
    documents = (placed.drop("_at", "_at_total").join(taken, "_row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
                 .join(known, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    return documents, pieces


def _mixed(docs: DataFrame, weights, share: float, block: int, seed: int, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(placed, pieces, quota): the documents in their sources' order with the columns ``carry``, the pieces, the sources."""
    own = flat(docs)
    text = F.col(f"c{place(docs, 'text')}").cast("string")
    own = own.select(*[F.col(f"c{place(docs, c)}").alias(c) for c in carry], F.col(f"c{place(docs, 'doc_id')}").cast("long").alias("doc_id"),
                     F.col(f"c{place(docs, 'source')}").cast("string").alias("source"), words_of(text).alias("size"), F.xxhash64(text).alias("_tie"))
    placed = running(own, ["source"], ["doc_id", "_tie"], "size", "_at", "mix-documents").drop("_tie")
    goal = targets(own.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share)

    # whole passes and the slots of the last, partial one; n_words > 0
    words, want = F.col("source_size"), F.round("target").cast("long")
    blocks = F.ceil(words / F.lit(block)).cast("long")
    passes = F.least(F.floor(want / words), F.lit(MOST_PASSES)).cast("long")
    rest = F.when(passes == MOST_PASSES, F.lit(0)).otherwise(want - passes * words)
    partial = F.ceil(rest / F.lit(block)).cast("long")
    quota = written(goal.select("source", F.col("source_size").alias("n_words"), "source_size", "target",
                        F.when(words > 0, passes * blocks + partial).otherwise(0).cast("long").alias("slots"),
                        F.when((words > 0) & (partial > 0), rest - (partial - 1) * block).otherwise(block).cast("long").alias("last")), "mix-targets")
    total = quota.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, round(total / SHARD_SLOTS))
    drawn = shard_counts(quota.filter("slots > 0").select("source", "n_words", "slots", "last"), shards, seed)
    # a few rows become all slots, which Spark's estimates can't see: tasks and the join are chosen by their number
    takes = slots(drawn.repartition(-(-total // TASK_SLOTS) or 1, "source", "shard"), block, seed)

    # a document's words lie in these blocks
    spans = (placed.filter("size > 0").select("source", "_row", "_at", "size")
             .withColumn("block", F.explode(F.sequence(F.floor(F.col("_at") / block), F.floor((F.col("_at") + F.col("size") - 1) / block)))))
    key = [F.xxhash64("source").alias("_s"), "block"]
    left = spans.select(*key, "_row", "_at", "size")
    right = takes.select(*key, "shard", "cut")
    start = F.greatest(F.lit(0), F.col("block") * block - F.col("_at"))
    end = F.least(F.col("size"), F.col("block") * block + F.col("cut") - F.col("_at"))
    pieces = left.join(right.hint("merge"), ["_s", "block"]).select("_row", "shard", "block", start.cast("long").alias("start"), end.cast("long").alias("end")).filter("end > start")
    return placed, pieces, quota


def _small(df: DataFrame) -> bool:
    """One row per source: broadcast it only if its measured row count is small."""
    return df.count() <= 10_000


def mixed_documents(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them, with the same columns: a document gives a row for every run of words taken in one
    go (runs of neighbouring blocks of the same pass are joined); a document of which nothing is taken gives none.  The
    text keeps its own white space inside a run; n_chars, where there is such a column, is the run's length."""
    names = docs.columns
    # the mix sees numbers and sizes; whole rows meet their runs at the end, in one shuffle
    own = written(flat(docs).withColumn("_id", F.monotonically_increasing_id()), "rows")
    slim = own.select("_id", *[F.col(f"c{place(docs, c)}").alias(c) for c in ("doc_id", "source", "text")])
    placed, pieces, _ = _mixed(slim, WEIGHTS, SHARE, block, seed, carry=("_id",))
    # the second time that a word range is taken is another pass
    turn = F.row_number().over(W.partitionBy("_row", "block").orderBy("shard", "end"))
    runs = pieces.withColumn("_turn", turn)
    per_doc = runs.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_turn", "start", "end"))).alias("_runs"))
    of_id = placed.select("_row", "_id").join(per_doc, "_row").select("_id", "_runs")
    rows = own.join(of_id, "_id").drop("_id")
    at = place(docs, "text")

    def cut(batch):
        import re

        word = re.compile(WORD)
        keep, texts = [], []
        for i, (text, runs_) in enumerate(zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist())):
            spots = [(m.start(), m.end()) for m in word.finditer(text)]
            joined: list[list[int]] = []
            for r in runs_:
                if joined and joined[-1][0] == r["_turn"] and joined[-1][2] == r["start"]:
                    joined[-1][2] = r["end"]
                else:
                    joined.append([r["_turn"], r["start"], r["end"]])
            for _, s, e in joined:
                keep.append(i)
                whole = s == 0 and e == len(spots)
                texts.append(text if whole else text[spots[s][0]:spots[e - 1][1]])
        import pyarrow as pa

        index = pa.array(keep, pa.int64())
        cols = {i: batch.column(i).take(index) for i in range(len(names))} | {at: texts}
        if "n_chars" in names:
            cols[names.index("n_chars")] = [len(t) for t in texts]
        return cols

    return map_batches(rows, cut, flat(docs).schema).toDF(*names)
