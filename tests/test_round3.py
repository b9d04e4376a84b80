"""Searches refined over a tree, merged history, versioned and sorted tables, one-pass dictionaries, rejects and the log."""

from __future__ import annotations

import json
import random
import uuid
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from jobnest.functions.scalars import BOOKKEEPING
from jobnest.operators import clean as C
from jobnest.operators import employers as E
from jobnest.operators.history import merge_history
from jobnest.operators.split import split_hits, split_searches
from jobnest.session import local_path, work_root
from jobnest.sinks.dictionaries import load_all
from jobnest.sinks.tables import ORDER_COL, broken_order, load_log, log_loads, replace_load, safe_name, sorted_load
from jobnest.sources.catalog import list_tables, read_table

TS = "2024-04-23 05:05:00"


@pytest.fixture
def schema(spark):
    name = "t3_" + uuid.uuid4().hex[:10]
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


# ---- F6 ----------------------------------------------------------------------------------------------------------


def refine(tree: dict, hits: list, limit: int) -> tuple[Counter, list]:
    """Searches by a recursive walk: (area, term, route, found), and the search of every hit."""
    children: dict = {}
    for a, p in tree.items():
        children.setdefault(p, []).append(a)
    below = lambda a: {a}.union(*[below(c) for c in children.get(a, [])])
    searches, at = Counter(), []

    def walk(a, term):
        inside = below(a)
        mine = [h for h in hits if h[1] == term and h[0] in inside]
        own = [h for h in mine if h[0] == a]
        if not mine:
            return
        if len(mine) <= limit or len(own) == len(mine):
            searches[a, term, "whole" if len(mine) <= limit else "over", len(mine)] += 1
            at.extend((h[2], a) for h in mine)
            return
        searches[a, term, "split", len(mine)] += 1
        if own:
            searches[a, term, "own" if len(own) <= limit else "over", len(own)] += 1
            at.extend((h[2], a) for h in own)
        for c in children.get(a, []):
            walk(c, term)

    for term in {h[1] for h in hits}:
        for root in children.get(None, []):
            walk(root, term)
    return searches, sorted(at)


@pytest.mark.parametrize("seed,limit", [(1, 5), (2, 1), (3, 1000), (4, 12)])
def test_searches_refined_over_random_trees(spark, seed, limit):
    rng = random.Random(seed)
    tree = {1: None, 2: None}
    for a in range(3, 40):
        tree[a] = rng.choice([None, *range(1, a), a - 1, a - 1])
    hits = [(rng.choice([1, 5, rng.randint(1, 39)]), rng.choice(["x", "y"]), i) for i in range(200)]
    hits += [(999, "x", 1000 + i) for i in range(3)]   # an area that the tree does not know
    paths = []
    for a in tree:
        path = [a]
        while tree[path[0]] is not None:
            path.insert(0, tree[path[0]])
        paths.append((a, path))
    h = spark.createDataFrame(hits, "area long, term string, id long").repartition(3)
    areas = spark.createDataFrame(paths, "area_id long, path_ids array<long>")
    searches = split_searches(h, areas, limit, per_page=4)
    want, at = refine({**tree, 999: None}, hits, limit)
    got = searches.collect()
    assert Counter((r.area, r.term, r.route, r.found) for r in got) == want
    assert all(r.pages == (None if r.route == "split" else -(-r.found // 4)) for r in got)
    placed = split_hits(h, areas, searches).collect()
    assert sorted((r.id, r.search_area) for r in placed) == at
    assert split_searches(h.where("false"), areas, limit).count() == 0


# ---- E14 ---------------------------------------------------------------------------------------------------------


def brute_history(loads: list, key) -> dict:
    state: dict = {}
    for day, rows in loads:
        new = {key(r): r for r in rows}
        for k in {*state, *new}:
            row, ins, upd, _, gone = state.get(k, (None, None, None, None, None))
            if k not in new:
                state[k] = (row, ins, upd if gone else day, 0, 1)
            elif row is None:
                state[k] = (new[k], day, day, 1, 0)
            else:
                state[k] = (new[k], ins, upd if row == new[k] and not gone else day, 1, 0)
    return state


@pytest.mark.parametrize("keys", [["id"], None])
def test_history_of_many_loads(spark, keys):
    rng = random.Random(5)
    loads = [(f"2024-01-{d:02}", [(i, rng.choice([None, "", "a"]), rng.choice([None, 1.5])) for i in range(40) if rng.random() < 0.7]) for d in range(1, 6)]
    loads.insert(3, ("2024-01-20", []))
    loads.sort()
    table = None
    for day, rows in loads:
        table = merge_history(table, spark.createDataFrame(rows, "id long, a string, b double"), day, keys).checkpoint()
    got = {(r.id if keys else (r.id, r.a, r.b)): ((r.id, r.a, r.b), str(r.md_ins_date), str(r.md_upd_date), r.md_is_activ, r.md_is_delete) for r in table.collect()}
    assert got == brute_history(loads, (lambda r: r[0]) if keys else (lambda r: r)) and len(got) == table.count()


def test_history_with_other_columns(spark):
    """A column that comes, one that goes, and one whose type changes; equal rows count once without keys."""
    one = merge_history(None, spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id long, gone string, n int"), "2024-01-01", ["id"])
    two = merge_history(one, spark.createDataFrame([(1, 5, "new"), (3, 7, None)], "id long, n long, more string"), "2024-01-02", ["id"])
    assert two.columns == ["id", "n", "more", "gone", *BOOKKEEPING] and dict(two.dtypes)["n"] == "bigint"
    got = {r.id: (r.n, r.more, r.gone, str(r.md_ins_date)[-2:], str(r.md_upd_date)[-2:], r.md_is_delete) for r in two.collect()}
    assert got == {1: (5, "new", None, "01", "02", 0), 2: (6, None, "b", "01", "02", 1), 3: (7, None, None, "02", "02", 0)}
    rows = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    first = merge_history(None, rows.distinct(), "2024-01-01")
    assert sorted(str(r.x) for r in merge_history(first, rows, "2024-01-02").collect()) == ["1", "None"]


# ---- K2 ----------------------------------------------------------------------------------------------------------


def test_a_failed_load_leaves_the_last_version(spark, schema):
    replace_load(spark.range(5), schema, "t", TS)
    reader = read_table(spark, schema, "t")
    bad = spark.range(0, 100, 1, 4).withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        replace_load(bad, schema, "t", TS)
    assert {r.id for r in read_table(spark, schema, "t").collect()} == set(range(5))
    # a load that reads what it replaces; whoever began to read before still can
    assert replace_load(read_table(spark, schema, "t").drop("process_dttm").where("id > 1"), schema, "t", TS) == {"table": f"{schema}.t", "rows": 3, "columns": 2}
    assert {r.id for r in reader.collect()} == set(range(5)) and {r.id for r in read_table(spark, schema, "t").collect()} == {2, 3, 4}
    # other columns, partitions, and no more than two versions on disk
    replace_load(spark.createDataFrame([("2024-04-01", 1.5), ("02", 2.5)], "load_day string, x double"), schema, "t", TS, partition_by=["load_day"])
    got = read_table(spark, schema, "t")
    assert dict(got.dtypes)["load_day"] == "string" and sorted((r.load_day, r.x) for r in got.collect()) == [("02", 2.5), ("2024-04-01", 1.5)]
    replace_load(spark.createDataFrame([("03", 3.5)], "load_day string, x double"), schema, "t", TS, partition_by=["load_day"])
    assert [tuple(r)[:1] for r in read_table(spark, schema, "t").select("x").collect()] == [(3.5,)]
    import os
    base = local_path(spark.catalog.getDatabase(schema).locationUri) + "/t"
    complete = [d for d in os.listdir(base) if os.path.exists(f"{base}/{d}/_SUCCESS")]
    assert len(complete) == 2
    replace_load(spark.range(0), schema, "t", TS)
    assert read_table(spark, schema, "t").count() == 0


# ---- K3 ----------------------------------------------------------------------------------------------------------


def test_all_dictionaries_in_one_pass(spark, schema):
    """Names that clash, types that differ from name to name, nested and missing keys, odd entries."""
    body = {"a": [{"id": 1, "x": {"y": True}}, {"id": 2}], "A": [{"id": "one", "x": {"y": 2}}], "empty": [], "b-c": {"id": 7, "list": [{"q": 1}]},
            "areas": [{"Id": 1.5}], "text": ["no object", 3], "mixed": [{"v": 1}, {"v": {"w": 2}}]}
    bodies = spark.createDataFrame([(json.dumps(body),), (json.dumps({"a": [{"id": 3, "z": "s"}]}),), (None,), ("no json",)], "body string")
    stats = {s["table"].split(".")[1]: (s["rows"], s["columns"]) for s in load_all(bodies, schema, TS)}
    show = lambda n: sorted((tuple(r) for r in read_table(spark, schema, safe_name(n)).drop("process_dttm").collect()), key=repr)
    assert show("a") == [(1, True, None), (2, None, None), (3, None, "s")] and read_table(spark, schema, "a").columns == ["id", "x.y", "z", "process_dttm"]
    assert show("A") == [("one", 2)] and show("b-c") == [(7, '[{"q":1}]')] and [c.lower() for c in read_table(spark, schema, safe_name("areas")).columns] == ["id", "process_dttm"]
    assert float(show("areas")[0][0]) == 1.5 and read_table(spark, schema, safe_name("text")).count() == 2
    assert sorted(r[0] for r in show("mixed")) == ["1", '{"w":2}']
    assert stats["a"] == (3, 4) and stats[safe_name("text")] == (2, 1)
    # again, with other types: tables become views and back
    load_all(spark.createDataFrame([(json.dumps({"a": [{"id": "t"}], "A": [{"id": "u"}]}),)], "body string"), schema, TS)
    assert show("a") == [("t",)] and show("A") == [("u",)]
    assert load_all(bodies.where("false"), schema, TS) == [] and show("a") == [("t",)]


def test_dictionary_jobs_do_not_grow_with_names(spark, schema):
    def jobs(n: int) -> int:
        body = json.dumps({f"d{i}": [{"id": i, f"c{i}": "x"}] for i in range(n)})
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, group)
        load_all(spark.createDataFrame([(body,)], "body string").checkpoint(), schema, TS)
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    jobs(1)
    assert jobs(2) == jobs(30)
    assert len(list_tables(spark, schema)) == 30


# ---- O1, O2, A3 --------------------------------------------------------------------------------------------------


def test_sorted_tables(spark, schema):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 1, 1, rng.randint(0, 50)]), rng.choice("abc")) for _ in range(3000)]
    sorted_load(spark.createDataFrame(rows, "k int, v string").repartition(7), schema, "s", TS, ["k"])
    table = read_table(spark, schema, "s")
    got = [(r.k, r.v) for r in table.orderBy(ORDER_COL).collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(r[ORDER_COL] for r in table.collect()) == list(range(3000))
    assert table.select(F.input_file_name()).distinct().count() > 1 and broken_order(table, ["k"]).count() == 0
    # the same rows in other files, out of order, are found out
    path = work_root(spark, "test-order", unique=True)
    table.repartition(3).write.parquet(path)
    assert broken_order(spark.read.parquet(path), ["k"]).count() == 3
    half = work_root(spark, "test-order", unique=True)
    table.where(f"{ORDER_COL} <> 1500").coalesce(1).sortWithinPartitions(ORDER_COL).write.parquet(half)
    assert [r.reason for r in broken_order(spark.read.parquet(half), ["k"]).collect()] == ["rows out of order"]
    sorted_load(spark.createDataFrame([], "k int"), schema, "none", TS, ["k"])
    assert read_table(spark, schema, "none").count() == 0 and broken_order(read_table(spark, schema, "none"), ["k"]).count() == 0


def test_load_log(spark):
    path = work_root(spark, "test-log", unique=True)
    log_loads(spark, path, "d1", [{"table": "a", "rows": 3, "columns": 2}, {"table": "b", "rows": 0, "columns": 1, "bad_rows": 4}], "2024-01-01 00:00:00")
    log_loads(spark, path, "d2", [{"table": "a", "rows": 5, "columns": 2}], "2024-01-02 00:00:00")
    log_loads(spark, path, "d1", [{"table": "a", "rows": 9, "columns": 2}], "2024-01-03 00:00:00")
    log_loads(spark, path, "d3", [], "2024-01-03 00:00:00")
    assert sorted((r.run, r.table, r.rows, r.columns, r.rejects) for r in load_log(spark, path).collect()) == [("d1", "a", 9, 2, 0), ("d1", "b", 0, 1, 4), ("d2", "a", 5, 2, 0)]


# ---- text ids and names ------------------------------------------------------------------------------------------


def test_text_ids_are_rejects(spark):
    raw = spark.createDataFrame([("1", None, "root"), ("x9", "1", "text"), ("2", "x9", "child"), ("3", "2", "below"), (None, "1", "none")], "area_id string, parent_id string, name string")
    clean, bad = C.split_areas(raw)
    assert sorted((r.area_id, r.parent_id, r._bad_reason) for r in bad.collect()) == [("2", "x9", "cast:parent_id"), ("x9", "1", "cast:area_id")]
    assert sorted((str(r.area_id), str(r.path)) for r in clean.collect()) == [("1", "1"), ("3", "1/x9/2/3"), ("None", "1")]
    bodies = spark.createDataFrame([('{"id":"e7","area":{"id":"1"}}',), ('{"id":"7","area":{"id":"q"}}',), ('{"errors":[]}',), ('{"id":"8","area":null}',)], "body string")
    got = E.employer_project(bodies, flag=True).collect()
    assert sorted((str(r._ids.id), str(r._bad_reason)) for r in got) == [("7", "cast:area_id"), ("8", "None"), ("None", "None"), ("e7", "cast:id")]


def test_names_of_reject_tables_are_reserved():
    assert all(safe_name(n) != n for n in ("employers_bad", "metro_lines_bad", "areas_bad", "vacancies_bad", "areas")) and safe_name("other_bad") == "other_bad"
