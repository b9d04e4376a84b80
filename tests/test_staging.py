"""Staging text dialect (FIXTURES.md §7), loads, catalogue, clean, incremental ingest."""

from __future__ import annotations

from hypothesis import given, settings, strategies as st

from jobnest.operators import clean as C
from jobnest.session import work_root
from jobnest.sinks.staging import accumulated, append_staging
from jobnest.sinks.tables import replace_load
from jobnest.sources.catalog import list_tables, read_table, schema_exists
from jobnest.sources.staging import read_staging
from jobnest.streaming.ingest import ingest_available, ingested

CELLS = ['a;b\n"q"', "", "NA", "['x', 'y']", "True", "  lead", "back\\slash"]


def test_staging_roundtrip_dialect(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(CELLS)], "k long, v string")
    path = work_root(spark, "t", "staging", unique=True)
    append_staging(df, path)
    back = {r["k"]: r["v"] for r in read_staging(spark, path, "k long, v string").collect()}
    # empty text comes back as NULL, as with the original's text staging
    assert back == {i: (c if c != "" else None) for i, c in enumerate(CELLS)}
    with open(_first_part(path), encoding="utf-8") as fh:
        head = fh.readline().strip()
    assert head == "k;v"                                         # header, ';' separator


def _first_part(path):
    import glob
    from jobnest.session import local_path
    return sorted(glob.glob(local_path(path) + "/part-*.csv"))[0]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list('ab ;"\n\r\\\t,é')), max_size=12), min_size=1, max_size=8))
def test_staging_roundtrip_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, v string")
    path = work_root(spark, "t", "prop", unique=True)
    append_staging(df, path)
    back = {r["k"]: r["v"] for r in read_staging(spark, path, "k long, v string").collect()}
    # only an empty string changes: it comes back as NULL
    assert back == {i: (t if t != "" else None) for i, t in enumerate(texts)}


def test_accumulate_appends(spark):
    path = work_root(spark, "t", "acc", unique=True)
    append_staging(spark.createDataFrame([(1, "a")], "k long, v string"), path)
    append_staging(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), path)
    assert accumulated(spark, path, "k long, v string").count() == 3   # duplicates are data


def test_replace_load_and_catalog(spark):
    schema = "t_raw_" + work_root(spark, unique=True).rsplit("/", 1)[-1][:8]
    info = replace_load(spark.createDataFrame([(1,), (2,)], "k long"), schema, "t1", "2024-04-23 05:05:00")
    assert info["rows"] == 2 and info["columns"] == 2
    replace_load(spark.createDataFrame([(3, "x")], "k long, s string"), schema, "t1", "2024-04-24 05:05:00")
    rows = read_table(spark, schema, "t1").collect()
    assert [(r["k"], r["s"], str(r["process_dttm"])) for r in rows] == [(3, "x", "2024-04-24 05:05:00")]
    spark.range(1).createOrReplaceTempView("not_a_table")
    assert list_tables(spark, schema) == ["t1"]
    assert schema_exists(spark, schema) and not schema_exists(spark, "no_such_schema_xyz")


def test_clean_table_tokens_casts_dedupe(spark):
    raw = spark.createDataFrame(
        [("1", " NA ", "2024-04-22T10:00:00+0300", "t1"), ("1", "NA", "2024-04-22T10:00:00+0300", "t2"),
         ("x", "ok", None, "t1"), (None, "z", None, "t1")],
        "id string, name string, published_at string, process_dttm string")
    good, bad = C.clean_table(raw, typed={"id": "bigint", "published_at": "timestamp"}, keys=["id"])
    g = good.collect()
    assert len(g) == 1 and g[0]["id"] == 1 and g[0]["name"] is None
    assert str(g[0]["published_at"]) == "2024-04-22 07:00:00"
    assert sorted(r["_bad_reason"] for r in bad.collect()) == ["cast:id", "null_key:id"]


def test_clean_areas_orphans(spark):
    raw = spark.createDataFrame([("1", None, "A"), ("2", "1", "B"), ("3", "2", "C"), ("5", "404", "orphan")],
                                "area_id string, parent_id string, name string")
    rows = {r["area_id"]: r for r in C.clean_areas(raw).collect()}
    assert rows[3]["depth"] == 2 and rows[3]["root_id"] == 1 and rows[3]["path"] == "1/2/3"
    assert rows[5]["depth"] is None and rows[5]["root_id"] is None


def test_incremental_ingest_picks_up_new_files_only(spark):
    root = work_root(spark, "t", "ingest", unique=True)
    spark.createDataFrame([("a",)], "body string").write.json(f"{root}/landing/batch=0")
    ingest_available(spark, f"{root}/landing", "body STRING, batch INT", f"{root}/table", f"{root}/ck")
    assert ingested(spark, f"{root}/table").count() == 1
    spark.createDataFrame([("b",), ("c",)], "body string").write.json(f"{root}/landing/batch=1")
    ingest_available(spark, f"{root}/landing", "body STRING, batch INT", f"{root}/table", f"{root}/ck")
    ingest_available(spark, f"{root}/landing", "body STRING, batch INT", f"{root}/table", f"{root}/ck")
    assert sorted(r["body"] for r in ingested(spark, f"{root}/table").collect()) == ["a", "b", "c"]


def test_streaming_vacancy_ingest_is_incremental(spark):
    import json as _json
    from jobnest.streaming.ingest import ingest_vacancies
    root = work_root(spark, "t", "vstream", unique=True)
    good_doc = {"id": "1", "area": {"id": "1"}, "experience": {}, "schedule": {}, "employment": {},
                "key_skills": [], "professional_roles": [{"id": "1"}], "employer": {"id": "2"}}
    spark.createDataFrame([("u1", _json.dumps(good_doc)), ("u2", "{}")], "url string, body string") \
        .write.json(f"{root}/landing/d=0")
    args = (f"{root}/landing", f"{root}/good", f"{root}/bad", f"{root}/ck")
    ingest_vacancies(spark, *args)
    spark.createDataFrame([("u3", _json.dumps({**good_doc, "id": "3"}))], "url string, body string") \
        .write.json(f"{root}/landing/d=1")
    ingest_vacancies(spark, *args)
    ingest_vacancies(spark, *args)            # nothing new: no change
    assert sorted(r["id"] for r in spark.read.parquet(f"{root}/good").collect()) == [1, 3]
    assert [r["_bad_reason"] for r in spark.read.parquet(f"{root}/bad").collect()] == ["area"]


def test_render_in_zone_keeps_the_instant(spark):
    from jobnest.functions.scalars import audit_timestamp, render_in_zone
    df = spark.range(1).select(audit_timestamp("2024-04-23 05:05:00").alias("ts"))
    r = df.select("ts", render_in_zone("ts", "Europe/Berlin").alias("berlin"),
                  render_in_zone("ts", "UTC").alias("utc")).first()
    assert r["utc"] == "2024-04-23 05:05:00" and r["berlin"] == "2024-04-23 07:05:00"
    assert str(r["ts"]) == "2024-04-23 05:05:00"


def test_clean_areas_duplicate_ids_take_the_general_path(spark):
    raw = spark.createDataFrame([("1", None, "A"), ("2", "1", "B"), ("2", "1", "B"), ("3", "2", "C"),
                                 ("3", "1", "C2")],   # id 3 listed under two parents
                                "area_id string, parent_id string, name string")
    rows = sorted((r["area_id"], r["parent_id"], r["depth"], r["path"]) for r in C.clean_areas(raw).collect())
    assert rows == [(1, None, 0, "1"), (2, 1, 1, "1/2"), (3, 1, 1, "1/3"), (3, 2, 2, "1/2/3")]
