"""MaxScore against plain scoring: thresholds, skipped shards, postings touched, numbers beyond a double's integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobnest.llm import maxscore as M


def plain(ids, values, name, q, k):
    scores = sorted((-sum(int(a) * int(b) for a, b in zip(v, q)), i) for i, v in zip(ids.tolist(), values.tolist()) if i != name)
    return [(i, -s) for s, i in scores[:k]]


@pytest.mark.parametrize("how", ["none", "exact", "above"])
def test_shard_top(how):
    rng = np.random.default_rng(3)
    values = np.floor(64 * rng.normal(0, 0.3, (500, 16)))
    values[40:60] = values[7]  # ties
    ids, query_ids = np.arange(500), np.arange(0, 500, 5)
    queries = values[query_ids]
    want = [plain(ids, values, i, q, 20) for i, q in zip(query_ids.tolist(), queries)]
    last = np.array([w[-1][1] for w in want], float)
    thresholds = {"none": np.full(100, -math.inf), "exact": last, "above": last + 1e9}[how]
    got = [list(zip(found.tolist(), map(int, scores))) for _, found, scores in M.shard_top(ids, values, query_ids, queries, thresholds, 20)]
    assert got == (want if how != "above" else [[]] * 100)


def test_opening_gives_lower_bounds_and_few_essential_terms():
    rng = np.random.default_rng(4)
    values = np.floor(64 * rng.normal(0, 0.3, (4000, 32)))
    values[:, 4:] = np.floor(values[:, 4:] / 8)  # a few strong terms
    ids, query_ids = np.arange(4000), np.arange(0, 4000, 100)
    queries = values[query_ids]
    opened = dict(M.opening(ids, values, query_ids, queries, 20))
    thresholds = np.array([opened[i][0] for i in query_ids.tolist()])
    for i, t in zip(query_ids.tolist(), thresholds):
        assert t <= plain(ids, values, i, values[i], 20)[-1][1]
    least, bound = M._bounds(values, queries)
    order, sums, n = M.essential(bound, M._lifted(thresholds, least.sum(axis=1)))
    # postings traversed: fewer than half of all
    assert 0 < n.mean() < 16
    assert (np.diff(sums, axis=1) <= 0).all() and (sums[:, -1] == 0).all()


def test_huge_components(spark):
    big = 1e308
    rows = [(0, [big, 1.0]), (1, [big, 2.0]), (2, [-big, 0.5]), (3, [2.0**60, 0.25]), (20, [1.0, 1.0]), (21, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(64 * x) if abs(x) < 2**53 else 64 * int(x) for x in v] for i, v in rows}
    cut = lambda x: max(-(2**63), min(2**63 - 1, x))
    got = {(r.query_id, r.vec_id): r.score for r in M.top_k(df, F.col("id") % 20 == 0).collect()}
    assert got == {(a, b): cut(sum(x * y for x, y in zip(whole[a], whole[b]))) for a in (0, 20) for b in whole if a != b}


def test_shards_and_openings(spark, monkeypatch):
    """A query opens some shards only; the result is that of all."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.5, 8)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = {tuple(r) for r in M.top_k(df, F.col("id") % 20 == 0).collect()}
    for name, n in (("SHARD", 30), ("QUERIES", 5), ("OPENINGS", 2), ("AT_ONCE", 3)):
        monkeypatch.setattr(M, name, n)
    assert {tuple(r) for r in M.top_k(df, F.col("id") % 20 == 0).collect()} == one and len(one) == 400
