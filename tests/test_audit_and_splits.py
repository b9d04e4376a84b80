"""Records found across file splits (S5), audit of broken bodies (S1, X3), employer parts that resume (K6)."""

from __future__ import annotations

import json

from hypothesis import given, settings, strategies as st

from jobnest.operators.audit import CORRUPT, metro_audit, readable
from jobnest.operators.metro import CITY
from jobnest.plans.landing import write_json_arrays
from jobnest.session import work_root
from jobnest.sinks.staging import append_staging
from jobnest.sources.landed import read_json_records
from jobnest.sources.staging import read_records, read_staging


def _small_splits(spark, size: str):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


def _usual_splits(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list('ab ;"\n,é')), max_size=40), min_size=1, max_size=12), st.sampled_from(["3b", "7b", "16b"]))
def test_records_across_splits(spark, texts, size):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, v string").coalesce(1)
    path = work_root(spark, "t", "splits", unique=True)
    append_staging(df, path)
    _small_splits(spark, size)
    try:
        back = [(r["k"], r["v"]) for r in read_staging(spark, path, "k long, v string").collect()]
    finally:
        _usual_splits(spark)
    assert sorted(back) == [(i, t if t != "" else None) for i, t in enumerate(texts)]


def test_one_file_is_read_by_several_tasks(spark):
    df = spark.range(2000).selectExpr("id", "concat('line one ', id, ';\n\"two\"\n', repeat('x', 50)) AS v").coalesce(1)
    path = work_root(spark, "t", "one_file", unique=True)
    append_staging(df, path)
    _small_splits(spark, "16k")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        back = read_staging(spark, path, df.schema)
        assert back.count() == 2000 and back.exceptAll(df).isEmpty()
    finally:
        _usual_splits(spark)


def test_headers_only_and_blank_lines(spark):
    path = work_root(spark, "t", "blank", unique=True)
    spark.createDataFrame([("k;v",), ("1;a",), ("",), ('2;"b',), ("",), ('c"',)], "value string").coalesce(1).write.text(path)
    assert sorted((r["k"], r["v"]) for r in read_staging(spark, path, "k long, v string").collect()) == [(1, "a"), (2, "b\n\nc")]
    empty = work_root(spark, "t", "header", unique=True)
    append_staging(spark.createDataFrame([], "k long, v string"), empty)
    assert read_records(spark, empty).isEmpty() and read_staging(spark, empty, "k long, v string").isEmpty()


CITIES = [
    {"id": "1", "name": "fine", "lines": [{"id": "7", "stations": [{"id": "7.1"}]}, {"id": "8", "stations": []}]},
    {"id": None, "name": "no rows", "lines": []},
    {"id": "x", "name": "text", "lines": [{"id": None, "stations": [{"id": "1"}, {"id": "1.z"}, {"id": None}, {"id": "1.2"}]}, {"id": "9"}]},
    {"id": "3", "name": "no list"},
]
BROKEN = [("text", "$.id", "cast:city_id", "x"), ("text", "$.lines[0].id", "null:metro_line_id", None),
          ("text", "$.lines[0].stations[0].id", "part:metro_station_id", "1"),
          ("text", "$.lines[0].stations[1].id", "cast:metro_station_id", "1.z"),
          ("text", "$.lines[0].stations[2].id", "null:metro_station_id", None),
          ("text", "$.lines[1].stations", "missing:stations", None), ("no list", "$.lines", "missing:lines", None)]


def test_audit_of_texts(spark):
    rows = [(c["name"], json.dumps(c)) for c in CITIES] + [("cut", '{"id": "1", "lines": ['), ("none", None)]
    found = metro_audit(spark.createDataFrame(rows, "name string, body string"), ["name"]).collect()
    assert sorted(map(str, [tuple(r) for r in found if r["rule"] != "json"])) == sorted(map(str, [*BROKEN, ("none", "$", "null:body", None)]))
    assert [(r["name"], r["path"]) for r in found if r["rule"] == "json"] == [("cut", "$")]


def test_audit_of_arrays(spark):
    path = work_root(spark, "t", "arrays", unique=True)
    bodies = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(CITIES)], "k long, body string")
    write_json_arrays(bodies, path, "k", per_file=3)
    rows = read_json_records(spark, path, readable(CITY), CORRUPT)
    assert rows.count() == len(CITIES)
    assert sorted(map(str, [tuple(r) for r in metro_audit(rows, ["name"], None).collect()])) == sorted(map(str, BROKEN))


def test_lost_part_is_asked_for_alone(spark):
    import pytest
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from jobnest.sinks.parts import finish, looked_up, lookup_runs, open_attempt, write_runs

    root = work_root(spark, "t", "parts", unique=True)
    batches = spark.range(10).selectExpr("cast(id div 2 as int) AS part", "cast(id % 2 as int) AS pos", "id")
    attempt = open_attempt(spark, root, batches)
    write_runs(batches, f"{attempt}/batches", 2)
    plain = lambda b: b.select("id")
    lost = lambda b: b.select(F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        lookup_runs(spark, f"{attempt}/batches", f"{attempt}/found", lost, 2)
    assert open_attempt(spark, root, batches) == attempt         # resumed, not begun anew
    assert lookup_runs(spark, f"{attempt}/batches", f"{attempt}/found", plain, 2) == [1, 2]
    assert lookup_runs(spark, f"{attempt}/batches", f"{attempt}/found", plain, 2) == []
    assert sorted(r["id"] for r in looked_up(spark, f"{attempt}/batches", f"{attempt}/found", plain, 2).collect()) == list(range(10))
    finish(spark, attempt)
    assert open_attempt(spark, root, batches) != attempt         # a finished day is asked for anew
    none = batches.limit(0)
    write_runs(none, f"{root}/none", 2)
    assert lookup_runs(spark, f"{root}/none", f"{root}/out", plain, 2) == [] and looked_up(spark, f"{root}/none", f"{root}/out", plain, 2).isEmpty()
