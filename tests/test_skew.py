"""One key holding a third of all rows: results stay exact and the hot key is split, not funnelled."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from conftest import bodies
from jobnest.operators import requests as R
from jobnest.operators import trees as TR
from jobnest.operators.vacancies import quarantine, vacancy_project

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _vacancy(i, area):
    return {"id": str(i), "name": "ring maker" if i % 2 else "gear", "area": {"id": str(area)},
            "experience": {"id": "e"}, "schedule": {"id": "s"}, "employment": {"id": "f"},
            "key_skills": [], "professional_roles": [{"id": "1"}], "employer": {"id": "7"},
            "published_at": "2024-04-22T10:00:00+0300"}


def test_hot_area_join_and_pages(spark):
    n, hot = 3000, 11
    areas = [{"id": "1", "parent_id": None, "name": "root", "areas": [
        {"id": str(a), "parent_id": "1", "name": f"a{a}", "areas": []} for a in range(10, 60)]}]
    docs = [_vacancy(i, hot if i % 3 == 0 else 10 + (i % 50)) for i in range(n)]
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        flat = TR.area_flatten(bodies(spark, [areas]), body_is_array=True)
        nodes = flat.select(F.col("area_id").cast("bigint").alias("area"),
                            F.col("root_id").cast("bigint").alias("root_area"))
        good, _ = quarantine(vacancy_project(bodies(spark, [json.dumps(d) for d in docs])))
        joined = good.join(nodes, "area")
        per_area = {r["area"]: r["n"] for r in joined.groupBy("area").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert per_area[hot] == sum(1 for i in range(n) if i % 3 == 0 or 10 + (i % 50) == hot)
        assert sum(per_area.values()) == n
        joined.collect()   # runs this QueryExecution, so its AQE plan becomes final
        final = joined._jdf.queryExecution().executedPlan().toString()   # AQE final plan after the run
        assert "isSkewJoin=true" in final or "skew=true" in final

        index = joined.withColumn("day", F.to_date(F.substring("published_at", 1, 10)))
        hits = R.search_hits(index.withColumn("root_area", F.col("area")), "ring")
        pages = R.assign_pages(hits, ["root_area", "term", "day"], ["id"])
        hot_rows = sorted((r["id"], r["page"], r["pos"]) for r in pages.where(F.col("root_area") == hot).collect())
        assert [(p, q) for _, p, q in hot_rows] == [(i // 100, i % 100) for i in range(len(hot_rows))]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
