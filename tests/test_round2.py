"""Deep and odd adjacency lists, table names from data, empty re-runs, rejected rows, failed id casts."""

from __future__ import annotations

import json

from jobnest.operators.clean import clean_areas
from jobnest.operators.trees import area_flatten
from jobnest.operators.vacancies import vacancy_project
from jobnest.plans.flows import RunConfig, clean_all
from jobnest.session import work_root
from jobnest.sinks.staging import accumulated, append_staging
from jobnest.sinks.tables import FIXED_TABLES, replace_load, safe_name
from jobnest.sources.catalog import read_table


def test_clean_areas_deep_repeated_and_cyclic(spark):
    rows = [("1", None, "r")] + [(str(i), str(i - 1), "n") for i in range(2, 151)]
    rows += [("7", "900", "again"), ("900", None, "s")]               # a repeated id under another parent
    rows += [("x1", "x2", "c"), ("x2", "x1", "c"), ("o", "missing", "o"), ("p", "o", "p")]
    got = {(r.area_id, r.parent_id, r.name): r for r in clean_areas(spark.createDataFrame(rows, "area_id string, parent_id string, name string")).collect()}
    assert len(got) == len(rows) - 1     # the two rows of the cycle have the same NULL ids
    assert got[150, 149, "n"].depth == 149 and got[150, 149, "n"].root_id == 1
    assert got[150, 149, "n"].path == "/".join(map(str, range(1, 151)))
    assert got[7, 900, "again"].depth == 1 and got[7, 900, "again"].path == "900/7"
    assert got[None, None, "c"].depth is None and got[None, None, "o"].path is None


def test_flatten_has_no_depth_limit(spark):
    node = {"id": "149", "parent_id": "148", "name": "n", "areas": []}
    for i in range(148, -1, -1):
        node = {"id": str(i), "parent_id": str(i - 1) if i else None, "name": "n", "areas": [node]}
    df = spark.createDataFrame([(0, json.dumps(node))], "k int, body string")
    got = area_flatten(df, root_order_col="k")
    assert got.count() == 150 and got.where("depth = 149").count() == 1


def test_names_do_not_collide():
    names = ["a-b", "A_b", "a_b", "a b", "areas", "Areas", "vacancies_bad", "", "_", "ä", "a_b__0123456789"]
    tables = [safe_name(n) for n in names]
    assert len(set(tables)) == len(names) and not set(tables) & set(FIXED_TABLES) and safe_name("a_b") == "a_b"


def test_empty_rerun_replaces_the_day(spark):
    path = work_root(spark, "test-rerun", unique=True)
    df = spark.createDataFrame([(1, "x")], "id int, name string")
    append_staging(df, path, "parquet", "2024-01-01")
    append_staging(df, path, "parquet", "2024-01-02")
    append_staging(df.limit(0), path, "parquet", "2024-01-01")
    got = accumulated(spark, path, "id int, name string, load_day string", "parquet", keep_load_day=True).collect()
    assert [(r.id, r.load_day) for r in got] == [(1, "2024-01-02")]


def test_rejected_rows_are_kept(spark):
    tag = work_root(spark, unique=True).rsplit("/", 1)[-1][:10]
    cfg = RunConfig("2024-01-02", "2024-01-02 05:05:00", raw_schema=f"r{tag}", clean_schema=f"c{tag}",
                    extra_clean={"by_name": "SELECT name, count(*) AS n FROM {raw}.employers GROUP BY name"})
    raw = spark.createDataFrame([("1", "a"), ("x9", "b"), (None, "c")], "id string, name string")
    replace_load(raw, cfg.raw_schema, "employers", cfg.run_ts)
    replace_load(raw, cfg.raw_schema, "status_bad", cfg.run_ts)      # a name from data, not a quarantine table
    stats = {s["table"].split(".")[1]: s for s in clean_all(spark, cfg)}
    bad = {r.name: r["_bad_reason"] for r in read_table(spark, cfg.clean_schema, "employers_bad").collect()}
    assert bad == {"b": "cast:id", "c": "null_key:id"} and stats["employers"]["bad_rows"] == 2
    assert read_table(spark, cfg.clean_schema, "status_bad").count() == 3
    assert read_table(spark, cfg.clean_schema, "by_name").count() == 3


def test_text_ids_are_flagged(spark):
    doc = {"id": "1", "area": {"id": "2"}, "experience": {}, "schedule": {}, "employment": {}, "key_skills": [], "professional_roles": [{"id": "3"}], "employer": {"id": "4"}}
    odd = [doc, {**doc, "id": "abc"}, {**doc, "area": {"id": "x1"}}, {**doc, "employer": {"id": "e7"}}]
    rows = vacancy_project(spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(odd)], "i int, body string"), keep=["i"])
    assert {r.i: r["_bad_reason"] for r in rows.collect()} == {0: None, 1: "cast:id", 2: "cast:area", 3: "cast:employer"}
