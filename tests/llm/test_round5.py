"""Larger tables: what does not repeat, and the longer text of a pair, is not shuffled."""

from __future__ import annotations

import re

from jobnest.llm import common, jaccard_join, passages


def _texts(n: int) -> list[str]:
    return [" ".join(f"word{i * 1000 + j}" for j in range(60)) for i in range(n)]


def test_digests_that_no_other_document_has_are_not_joined(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(passages, "written", lambda df, what, write=passages.written: kept.setdefault(what, write(df, what)))
    texts = _texts(200)
    shared = " ".join(f"same{j}" for j in range(40))
    rows = [(i, f"{t} {shared}" if i % 50 == 0 else t) for i, t in enumerate(texts)]
    got = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} >= {(0, 0), *((i, 0) for i in (50, 100, 150))}
    assert all(rows[r.doc_id][1].encode()[r.start:r.end].decode() == shared for r in got)
    own = passages.digests(spark.createDataFrame(rows, "doc_id long, text string"))
    assert kept["digests"].count() < own.count() / 5
    again = own.groupBy("digest").count().filter("count > 1").count()
    assert again <= kept["several"].count() < own.count() / 5


def test_several_is_told_across_partitions_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(common, "HELD", 8)
    rows = [(i, t) for i, t in enumerate(_texts(40) * 3)]
    own = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = {r.digest & common.COUNTED for r in passages.digests(own).select("digest").distinct().collect()}
    assert sorted(want) == sorted(r.key for r in passages.several(own).collect())
    assert passages.several(own.limit(0)).count() == 0


def test_the_shorter_text_of_a_pair_goes_to_the_longer_one(spark):
    shared = " ".join(f"same{j}" for j in range(40))
    rows = [(1, shared), (2, f"{shared} {_texts(3)[2] * 20}"), (3, f"short {shared}"), (3, f"short {shared}"), (None, shared)]
    df = passages.repeated(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"octet_length", plan)
    text = {i: t.encode() for i, t in rows}
    got = {(r.doc_id, r.start, r.end, r.first_doc_id) for r in df.collect()}
    assert {(d, f) for d, _, _, f in got} == {(1, 1), (2, 1), (3, 1)}
    assert all(text[d][s:e].decode() == shared for d, s, e, _ in got)


def _family(n: int, words: int = 60, change: int = 4) -> list[str]:
    return [" ".join(f"x{i}x{j}" if (i + j) % words < change else f"word{j}" for j in range(words)) for i in range(n)]


def test_pivots_that_no_other_has_are_not_dealt(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    kept = {}
    monkeypatch.setattr(jaccard_join, "written", lambda df, what, write=jaccard_join.written: kept.setdefault(what, []).append(write(df, what)) or kept[what][-1])
    texts = _texts(100) + _family(30) + _family(30)[:3]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.join(docs).collect()}
    sets = [set(jaccard_join.hashes(t.encode(), 5).tolist()) for t in texts]
    up = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((up[a], up[b]))
                up = [low if x == high else x for x in up]
    assert got == dict(enumerate(up))
    postings = sum(len(jaccard_join.first_pivots(jaccard_join.hashes(t.encode(), 5), 80, None)) for t in texts[:130])
    shared = kept["shared"][0].count()
    assert 0 < shared < postings / 4
    assert kept["regions"][0].count() < postings / 2
    # one copy of the sketches, and in blocks only pivots that others have
    assert len(kept["sketches"]) == 1
    for held in kept["pivots"]:
        n = [p for r in held.collect() for p in r.pivots]
        assert all(n.count(p) > 1 for p in n)


def test_frequent_counts_more_than_two(spark):
    import numpy as np

    rows = spark.range(1000).repartition(4).selectExpr("id % 10 as x", "id").filter("x < 5 or id < 20").select("x")
    numbers = lambda batch: [batch.column(0).to_numpy().astype(np.uint64)]
    assert sorted(r.key for r in common.frequent(rows, numbers, 50).collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.key for r in common.frequent(rows, numbers, 1).collect()) == list(range(10))
    assert common.frequent(rows, numbers, 100).count() == 0
