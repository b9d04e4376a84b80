"""Searches with many hits reach the branches that small searches do not."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from jobnest.operators import requests as R
from jobnest.plans import wide as W


def test_answer_searches_keeps_empty_ones(spark):
    searches = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "area int, term string")
    hits = spark.createDataFrame([(1, "a")] * 3 + [(9, "a")], "area int, term string")
    got = R.answer_searches(searches, hits, ["area", "term"], per_page=2).collect()
    assert {tuple(r) for r in got} == {(1, "a", 3, 2), (1, "b", 0, 0), (2, "a", 0, 0)}
    assert R.answer_searches(searches.limit(0), hits, ["area", "term"]).count() == 0


def test_branches_are_reached(spark):
    counts = W.wide_counts(spark, SF_ORACLE)
    assert counts.where("pages > 1").count() and counts.where("found = 0").count()
    plan, reference = W.wide_request_plan(spark, SF_ORACLE), W.wide_request_plan_reference(spark, SF_ORACLE)
    assert plan.where("page > 0").count() and plan.exceptAll(reference).count() and reference.exceptAll(plan).count()
    assert not plan.join(counts.where("found = 0"), W.KEY, "left_semi").count()
    details = W.wide_details(spark, SF_ORACLE)
    n = details.agg(*[F.count_if(F.expr(e)) for e in ("has_detail", "not has_detail", "bad_reason is null")]).first()
    assert min(n) > 0
    # some good items stand behind a bad one
    kept = W.wide_page_abort(spark, SF_ORACLE)
    assert 0 < kept.count() < n[2] and kept.groupBy(*W.PAGE).agg(F.max("pos").alias("p")).where("p > 0").count()


def test_every_item_is_on_one_page(spark):
    items = W.items(spark, SF_ORACLE)
    assert items.groupBy(*W.PAGE).count().agg(F.max("count")).first()[0] == R.PER_PAGE
    hits = W.hits(spark, SF_ORACLE).select(*W.KEY, "url")
    assert not hits.exceptAll(items.select(*W.KEY, "url")).count() and hits.count() == items.count()
