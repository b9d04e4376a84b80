"""Exact top-k by inner product with MaxScore.

Vectors are turned into integers; a *term* is a dimension, and its postings in a shard are the shard's vectors with their
value there.  A query's score splits into one contribution a term.  Lifted by the smallest contribution that the shard
allows, a contribution lies between 0 and the term's bound.  Two passes:

1. *Opening.*  Every query meets ``OPENINGS`` shards and scores the heads of its two strongest terms' postings in impact
   order.  The k-th best score of all these is the query's threshold: a score that its k-th best vector reaches at least.
2. *Search.*  Every query meets every shard with this threshold.  Terms whose bounds together cannot reach it are
   non-essential.  The essential terms' postings are traversed, for a block of queries at once; the other terms are
   probed, the largest bounds first, only for vectors that are still competitive (if these are many, the postings of the
   other terms are traversed as well).  A shard where all bounds together stay
   below the threshold is skipped.

Every vector that might reach the threshold, ties included, is scored in full, so the result is exact.  The shards' best
are merged.

Vectors that are null or hold a null or non-finite component take no part, nor do rows without an id; of rows that
repeat an id the one with the smallest vector counts.  A shorter vector counts as filled up with zeros.  Scores beyond a
long are cut to its range.  An empty table, or a single vector, gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_schema, pick, written

K = 20
QUERY_STEP = 20
SCALE = 64
#: Vectors of a shard and queries of a block: what one task holds at a time.
SHARD, QUERIES = 8192, 512
#: Shards in which a query's threshold is found, and postings scored there of each of its two strongest terms.
OPENINGS, HEADS = 8, 64
#: Queries whose scores over a shard are held at a time.
AT_ONCE = 64
#: Non-essential terms probed at first (then twice as many, and so on), where at most one vector in ``FEW`` is competitive;
#: vectors probed at a time.
PROBES, FEW, PAIRS = 8, 16, 1 << 14


def vectors(rows: DataFrame) -> DataFrame:
    """(id, v) of the rows (vec_id, embedding) that take part: v as doubles, once per id."""
    v = pick(rows, vec_id="long", embedding="array<double>")
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.filter(F.coalesce(good, F.lit(False))).groupBy(F.col("vec_id").alias("id")).agg(F.min("embedding").alias("v"))


def _matrix(lists) -> np.ndarray:
    """Integers floor(SCALE * x) of an Arrow list column, rows filled up with zeros: as doubles where these are exact, else
    as Python integers."""
    ends = lists.offsets.to_numpy()
    flat, size = lists.values.to_numpy(zero_copy_only=False)[ends[0]: ends[-1]], np.diff(ends)
    m = np.zeros((len(size), int(size.max(initial=0))))
    m[np.arange(m.shape[1]) < size[:, None]] = flat
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * m)
    if not m.size or np.abs(scaled).max() < 2**52:
        return scaled
    # beyond 2**53 a double is an integer
    whole = lambda x: int(x) * SCALE if abs(x) >= 2**53 else int(np.floor(SCALE * x))
    return np.array([[whole(x) for x in r] for r in m.tolist()], dtype=object).reshape(m.shape)


def _alike(values: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions that both have, in numbers that hold every score exactly."""
    width = min(values.shape[1], queries.shape[1])
    values, queries = values[:, :width], queries[:, :width]
    exact = values.dtype != object and queries.dtype != object and (not values.size or not queries.size or width * float(np.abs(values).max()) * float(np.abs(queries).max()) < 2**52)
    if exact:
        return values, queries
    whole = lambda m: m if m.dtype == object else np.array([[int(x) for x in r] for r in m.tolist()], dtype=object).reshape(m.shape)
    return whole(values), whole(queries)


def _bounds(values: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every query and term the smallest contribution in the shard, and the bound of what is above it."""
    low, high = values.min(axis=0), values.max(axis=0)
    least = np.minimum(queries * low, queries * high)
    return least, np.maximum(queries * low, queries * high) - least


def opening(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Yield (query id, scores): the k best among the heads of the postings of every query's two strongest terms."""
    values, queries = _alike(values, queries)
    if not len(ids) or not values.shape[1]:
        return
    bound = _bounds(values, queries)[1]
    impact = np.argsort(values, axis=0, kind="stable")
    lowest, highest = impact[:HEADS].T, impact[-HEADS:].T
    for at in range(0, len(query_ids), AT_ONCE):
        q, names = queries[at: at + AT_ONCE], query_ids[at: at + AT_ONCE]
        strong = np.argsort(-bound[at: at + AT_ONCE], axis=1, kind="stable")[:, :2]
        rising = np.take_along_axis(q, strong, axis=1) > 0
        heads = np.where(rising[:, :, None], highest[strong], lowest[strong]).reshape(len(q), -1)
        heads.sort(axis=1)
        once = np.ones(heads.shape, bool)
        once[:, 1:] = heads[:, 1:] != heads[:, :-1]
        once &= ids[heads] != names[:, None]
        scores = (values[heads] * q[:, None, :]).sum(axis=2)
        for name, mine, good in zip(names.tolist(), scores, once):
            yield name, np.sort(mine[good])[-k:]


def _lifted(thresholds: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Thresholds above the smallest score; without a threshold -1, which every sum of bounds reaches."""
    if base.dtype != object:
        return np.where(np.isneginf(thresholds), -1, thresholds - base)
    return np.array([-1 if np.isneginf(t) else int(t) - b for t, b in zip(thresholds.tolist(), base.tolist())], dtype=object)


def essential(bound: np.ndarray, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every query its terms from the largest bound on, the sums of the bounds from each of them on (0 at the end), and
    how many of them are essential: those where this sum reaches the threshold."""
    order = np.argsort(-bound, axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(bound, order, axis=1)[:, ::-1], axis=1)[:, ::-1]
    sums = np.concatenate([sums, np.zeros((len(bound), 1), bound.dtype)], axis=1)
    return order, sums, (sums[:, :-1] >= lifted[:, None]).sum(axis=1)


def shard_top(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, thresholds: np.ndarray, k: int):
    """Yield (query id, ids, scores) of the k best vectors of a shard that reach the query's threshold (-inf: none)."""
    values, queries = _alike(values, queries)
    if not len(ids):
        return
    across = np.ascontiguousarray(values.T)
    least, bound = _bounds(values, queries)
    base = least.sum(axis=1)
    for at in range(0, len(query_ids), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        q, low, names, lifted = queries[some], least[some], query_ids[some], _lifted(thresholds[some], base[some])
        order, sums, n = essential(bound[some], lifted)
        row, width = np.arange(len(q)), q.shape[1]
        at_term = np.empty_like(order)
        np.put_along_axis(at_term, order, np.broadcast_to(np.arange(width), order.shape), axis=1)
        # the terms from one place to another in each query's order: factors, and the smallest contributions
        between = lambda x, y: (np.where(c := (at_term >= x[:, None]) & (at_term < y[:, None]), q, 0), np.where(c, low, 0).sum(axis=1))  # noqa: B023,E731
        factors, less = between(np.zeros_like(n), n)
        part = factors @ across - less[:, None]
        # nothing essential though the threshold is above all bounds: the shard is skipped
        may = (part + sums[row, n][:, None] >= lifted[:, None]) & (ids != names[:, None])
        # where many vectors are competitive, the other postings are traversed too
        many = np.flatnonzero((may.sum(axis=1) > len(ids) // FEW) & (n < width))
        if len(many):
            factors, less = between(n, np.full_like(n, width))
            part[many] += factors[many] @ across - less[many][:, None]
            may[many] &= part[many] >= lifted[many][:, None]
            n[many] = width
        mine, found = np.nonzero(may)
        score = part[mine, found]
        step = PROBES
        while len(mine) and (n[mine] < width).any():
            to = np.minimum(n + step, width)
            factors, less = between(n, to)
            for x in range(0, len(mine), PAIRS):
                m = mine[x: x + PAIRS]
                score[x: x + PAIRS] += (values[found[x: x + PAIRS]] * factors[m]).sum(axis=1) - less[m]
            n, step = to, step * 2
            stay = score + sums[mine, n[mine]] >= lifted[mine]
            mine, found, score = mine[stay], found[stay], score[stay]
        ends = np.searchsorted(mine, np.arange(len(q) + 1))
        for i, (x, y) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            got, own = score[x:y], ids[found[x:y]]
            if len(got) > k:
                top = got >= np.sort(got)[-k]
                got, own = got[top], own[top]
            best = np.array(sorted(range(len(got)), key=lambda j: (-got[j], own[j]))[:k], int) if got.dtype == object else np.lexsort((own, -got))[:k]
            yield int(names[i]), own[best], got[best] + base[at + i]


def _met(data: DataFrame, queries: DataFrame, shards: int, answer, columns: str) -> DataFrame:
    """What ``answer(shard ids, shard values, query ids, query values, thresholds)`` yields as dicts for each block of
    queries of each shard.  ``data``: shard, block (-1), id, v, threshold; ``queries``: the same with the blocks' numbers."""
    schema = arrow_schema(columns)
    both = data.unionByName(queries).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "block", "id")

    def run(batches):
        import pyarrow as pa

        held, parts, last = None, [], None

        def flush():
            nonlocal held
            rows = pa.Table.from_batches(parts).combine_chunks()
            ids, v, least = (rows.column(c).combine_chunks() for c in ("id", "v", "threshold"))
            if last[1] == -1:
                held = ids.to_numpy(), _matrix(v)
                return
            lows = least.cast(pa.float64()).fill_null(float("-inf")).to_numpy(zero_copy_only=False)
            for out in answer(*held, ids.to_numpy(), _matrix(v), lows):
                yield pa.RecordBatch.from_pydict(out, schema=schema)

        for batch in batches:
            at = 0
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            for end in [*(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]:
                if end == at:
                    continue
                key = tuple(keys[:, at].tolist())
                if key != last:
                    if parts:
                        yield from flush()
                    parts = []
                    if last is None or key[0] != last[0]:
                        held = np.zeros(0, np.int64), np.zeros((0, 0))
                    last = key
                parts.append(batch.slice(at, end - at))
                at = end
        if parts:
            yield from flush()

    return both.mapInArrow(run, columns)


def _long(x) -> int:
    return max(-(2**63), min(2**63 - 1, int(x)))


def top_k(rows: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose ``id`` satisfies ``is_query`` the k best other rows.

    Shards and blocks of queries have bounded sizes and are dealt out by number.  A task keeps one shard and one block; a
    query's scores over a shard are held for ``AT_ONCE`` queries."""
    all_ = written(vectors(rows), "vectors")
    n = all_.count()
    n_queries = all_.filter(is_query).count()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-n_queries // QUERIES))
    spread = lambda parts, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts)).cast("int")
    none = F.lit(None).cast("double").alias("threshold")
    data = all_.select(spread(shards, 1).alias("shard"), F.lit(-1).alias("block"), "id", "v", none)
    asked = all_.filter(is_query).withColumn("block", spread(blocks, 2))
    # the shards that a query opens follow each other, from one that its block chooses
    where = F.transform(F.sequence(F.lit(0), F.lit(min(shards, OPENINGS) - 1)), lambda i: ((F.col("block") + i) % shards).cast("int"))

    def begin(ids, values, query_ids, queries, _):
        got = list(opening(ids, values, query_ids, queries, k))
        yield {"id": [name for name, scores in got for _ in scores], "score": [_long(x) for _, scores in got for x in scores]}

    heads = _met(data, asked.select(F.explode(where).alias("shard"), "block", "id", "v", none), shards, begin, "id long, score long")
    nth = F.row_number().over(W.partitionBy("id").orderBy(F.desc("score")))
    # a double may be above a long beyond 2**53: such scores, and those cut to a long, give no threshold
    usable = F.abs(F.col("score").cast("double")) < 2.0**53
    known = heads.withColumn("nth", nth).filter((F.col("nth") == k) & usable).select("id", F.col("score").cast("double").alias("threshold"))
    asked = written(asked.join(known, "id", "left").select("block", "id", "v", "threshold"), "asked")

    def search(ids, values, query_ids, queries, lows):
        for query, found, scores in shard_top(ids, values, query_ids, queries, lows, k):
            if len(found):
                yield {"query_id": [query] * len(found), "vec_id": found.tolist(), "score": [_long(x) for x in scores]}

    everywhere = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block", "id", "v", "threshold")
    found = _met(data, everywhere, shards, search, "query_id long, vec_id long, score long")
    place = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
