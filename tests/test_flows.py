"""The daily chain end to end over a landing folder built from the smallest data set."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from jobnest.plans import flows, stages
from jobnest.plans import landing as L
from jobnest.session import work_root
from jobnest.sources.catalog import list_tables, read_table


def _land(spark, root):
    for name in ("dictionaries", "areas", "metro"):
        L.landed(spark, SF_SMALL, name).select("body").write.text(f"{root}/{name}")
    (stages.list_page_bodies(spark, SF_SMALL).withColumnRenamed("root_area", "area")
     .write.parquet(f"{root}/list_pages"))
    L.landed(spark, SF_SMALL, "vacancies").select("url", "body").write.parquet(f"{root}/vacancies")
    L.landed(spark, SF_SMALL, "employers").select("url", "body").write.parquet(f"{root}/employers")


def _busiest_run_date(spark):
    import datetime
    busiest = (stages.list_page_bodies(spark, SF_SMALL).groupBy("day").count()
               .orderBy(F.desc("count"), "day").first()["day"])
    return busiest, str(busiest + datetime.timedelta(days=1))


def test_run_daily_original_behaviour(spark):
    """';' text staging, page abort and the original page numbering, run twice (accumulation)."""
    root = work_root(spark, "t", "flow2", unique=True)
    _land(spark, f"{root}/landing")
    busiest, run_date = _busiest_run_date(spark)
    suffix = root.rsplit("/", 1)[-1][:8]
    cfg = flows.RunConfig(run_date=run_date, run_ts="2024-04-23 05:05:00", terms=stages.TERMS,
                          raw_schema=f"oraw_{suffix}", clean_schema=f"oclean_{suffix}",
                          staging_dir=f"{root}/staging", staging_fmt="csv", on_error="abort_page",
                          page_mode="reference", body_layout="lines", bookkeeping=True,
                          idempotent_days=False)
    first = flows.run_daily(spark, f"{root}/landing", cfg)["vacancies"]["rows"]
    second = flows.run_daily(spark, f"{root}/landing", cfg)["vacancies"]["rows"]
    details = stages.page_details(spark, SF_SMALL, page_mode="reference").where(F.col("day") == busiest)
    from jobnest.operators.vacancies import page_abort
    expected = page_abort(details, stages.PAGE_KEY, "pos").count()
    assert first == expected > 0 and second == 2 * first        # staging is never emptied (K4)
    clean = read_table(spark, cfg.clean_schema, "vacancies")
    assert clean.count() == first                                # clean de-duplicates
    assert "md_is_activ" in clean.columns


def test_run_daily(spark):
    root = work_root(spark, "t", "flow", unique=True)
    _land(spark, f"{root}/landing")
    busiest = (stages.list_page_bodies(spark, SF_SMALL).groupBy("day").count()
               .orderBy(F.desc("count"), "day").first()["day"])
    run_date = str(busiest + __import__("datetime").timedelta(days=1))
    suffix = root.rsplit("/", 1)[-1][:8]
    cfg = flows.RunConfig(run_date=run_date, run_ts="2024-04-23 05:05:00", terms=stages.TERMS,
                          raw_schema=f"fraw_{suffix}", clean_schema=f"fclean_{suffix}",
                          staging_dir=f"{root}/staging", body_layout="lines")
    stats = flows.run_daily(spark, f"{root}/landing", cfg)
    again = flows.run_daily(spark, f"{root}/landing", cfg)        # same day again: replaced, not doubled
    assert again["vacancies"]["rows"] == stats["vacancies"]["rows"]
    raw = set(list_tables(spark, cfg.raw_schema))
    assert {"areas", "metro_lines", "metro_stations", "vacancies", "employers", "orders"} <= raw
    clean = set(list_tables(spark, cfg.clean_schema))
    rejects = {f"{t}_bad" for t in ("employers", "metro_lines", "metro_stations", "vacancies")}
    assert clean == (set(raw) - {"vacancies_bad"}) | rejects
    expected = (stages.page_details(spark, SF_SMALL).where(F.col("day") == busiest)
                .where(F.col("_bad_reason").isNull()).count())
    assert stats["vacancies"]["rows"] == expected > 0
    vac = read_table(spark, cfg.raw_schema, "vacancies")
    assert str(vac.select("load_day").distinct().collect()[0][0]) == run_date     # partitioned by load day
    plan = vac.where(F.col("load_day") == run_date)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_day" in plan
    assert "load_day" not in read_table(spark, cfg.clean_schema, "vacancies").columns
    emp = read_table(spark, cfg.raw_schema, "employers")
    assert emp.count() == read_table(spark, cfg.raw_schema, "vacancies").select("employer").where(
        "employer IS NOT NULL").distinct().count()
    areas = read_table(spark, cfg.clean_schema, "areas")
    assert areas.where("depth IS NULL").count() == 0


def test_run_daily_whole_response_files(spark):
    """Landing as the API returns it: one JSON object (dictionaries), one JSON array (areas, metro)."""
    import json
    root = work_root(spark, "t", "flow3", unique=True)
    land = f"{root}/landing"
    # test fixture: merge the per-customer stand-ins into single response files
    dicts: dict = {}
    for r in L.landed(spark, SF_SMALL, "dictionaries").orderBy("body_key").collect():
        for k, v in json.loads(r["body"]).items():
            dicts.setdefault(k, []).extend(v)
    areas = [json.loads(r["body"]) for r in L.landed(spark, SF_SMALL, "areas").orderBy("root_key").collect()]
    metro = [json.loads(r["body"]) for r in L.landed(spark, SF_SMALL, "metro").orderBy("city_key").collect()]
    for name, doc in (("dictionaries", dicts), ("areas", areas), ("metro", metro)):
        spark.createDataFrame([(json.dumps(doc, indent=1),)], "v string").coalesce(1).write.text(f"{land}/{name}")
    (stages.list_page_bodies(spark, SF_SMALL).withColumnRenamed("root_area", "area")
     .write.parquet(f"{land}/list_pages"))
    L.landed(spark, SF_SMALL, "vacancies").select("url", "body").write.parquet(f"{land}/vacancies")
    L.landed(spark, SF_SMALL, "employers").select("url", "body").write.parquet(f"{land}/employers")
    busiest, run_date = _busiest_run_date(spark)
    suffix = root.rsplit("/", 1)[-1][:8]
    cfg = flows.RunConfig(run_date=run_date, run_ts="2024-04-23 05:05:00", terms=stages.TERMS,
                          raw_schema=f"wraw_{suffix}", clean_schema=f"wclean_{suffix}",
                          staging_dir=f"{root}/staging", body_layout="file")
    stats = flows.run_daily(spark, land, cfg)
    assert stats["areas"]["rows"] == sum(1 for _ in _nodes(areas))
    assert stats["metro"][1]["rows"] == sum(len(l["stations"]) for c in metro for l in c["lines"])
    assert {d["table"].split(".")[1] for d in stats["dictionaries"]} == set(dicts)
    orders = read_table(spark, cfg.raw_schema, "orders")
    assert orders.count() == len(dicts["orders"])


def _nodes(trees):
    for t in trees:
        yield t
        yield from _nodes(t.get("areas") or [])
