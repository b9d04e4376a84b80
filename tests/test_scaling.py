"""Shuffles and passes of the shared steps: bodies, searches, lookups, loads and clean areas."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from jobnest.operators import clean as C
from jobnest.operators import trees as TR
from jobnest.plans import landing as L
from jobnest.plans import queries as Q
from jobnest.plans import stages as S


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture()
def tables(spark, tmp_path):
    """Orders 1 and 2 of customer 7, order 3 of nobody; part 5 comes twice."""
    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    day = "timestamp'1998-01-02'"
    save("customer", [(7, "c7", 1, 10.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    save("lineitem", [(1, 5, 9, 2, 1.0, 0.1), (1, 6, 9, 1, 50.0, 0.2), (2, 5, 9, 1, 3.0, 0.3)],
         "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double")
    orders = spark.createDataFrame([(1, 7, "F", 10.0, "1-URGENT"), (2, 7, "O", 11.0, "2-HIGH"), (3, None, "P", 12.0, "5-LOW")],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string")
    orders.withColumn("o_orderdate", F.expr(day)).write.parquet(f"{tmp_path}/orders.parquet")

    def parts(*keys):
        save("part", [(k, f"part {k} {i}") for i, k in enumerate(keys)], "p_partkey long, p_name string")
        return str(tmp_path)
    return parts


@pytest.mark.parametrize("keys, lines", [((5, 6), 3), ((5, 5, 6), 5)])
def test_bodies_hold_an_item_for_every_part_of_its_key(spark, tables, keys, lines):
    sf = tables(*keys)
    flat = TR.area_flatten(L.area_bodies(spark, sf), root_order_col="root_key")
    assert flat.where("name like 'line%'").count() == lines
    stations = L.metro_bodies(spark, sf).select(F.regexp_count("body", F.lit('"lat"')).alias("n")).first()["n"]
    order1 = 2 if lines == 3 else 3     # a finished order is listed twice
    assert stations == 2 * order1 + (lines - order1)
    assert L.vacancy_bodies(spark, sf).count() == 3


def test_bodies_are_landed_without_items_and_without_a_shuffle_of_bodies(spark):
    L._LANDED.clear()
    for name in ("vacancies", "areas", "metro", "dictionaries"):
        L.landed(spark, SF_SMALL, name)
    assert [set(done) for done in L._LANDED.values()] == [{"vacancies", "areas", "metro", "dictionaries"}]
    for build in (L.vacancy_bodies, L.area_bodies, L.metro_bodies, L.dictionary_bodies):
        top = _plan(build(spark, SF_SMALL)).split("Repartition")[0]
        assert "AS body#" in top, build.__name__


def test_titles_are_matched_below_the_join_with_the_areas(spark):
    plan = _plan(S.search_hits(spark, SF_SMALL))
    assert plan.index("Join Inner") < plan.index("Generate explode")


def test_pages_are_dealt_without_urls_and_titles(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(S.R, "assign_pages", lambda hits, *a, **k: seen.append(hits.columns) or hits)
    S.assigned_pages(spark, SF_SMALL)
    assert seen == [["root_area", "term", "day", "id"]]


def test_detail_lookup_shuffles_no_document(spark):
    df = Q.detail_lookup(spark, SF_SMALL)
    join = next(line for line in _plan(df).splitlines() if "Join LeftOuter" in line)
    assert join
    details = _plan(df).split("Join LeftOuter")[1]
    assert "isnotnull(body" in details
    assert df.where("has_detail").count() == df.count() > 0


def test_deeper_trees_are_found_by_their_child_lists(spark):
    def tree(levels):
        body = '"areas":[]'
        for i in range(levels):
            body = f'"areas":[{{"id":"{i}","name":"n","parent_id":null,{body}}}]'
        return "{" + f'"id":"r","name":"r","parent_id":null,{body}' + "}"
    df = spark.createDataFrame([(n, tree(n)) for n in range(6)] + [(9, None), (10, "{broken")], "n int, body string")
    arr = F.array(F.from_json("body", TR._below(TR.LEVELS_PER_PASS)))
    assert sorted(r["n"] for r in df.where(TR._goes_deeper(arr, TR.LEVELS_PER_PASS)).collect()) == [4, 5]
    flat = TR.area_flatten(df.where("n < 9"), root_order_col="n")
    assert {r["root_order"]: r["count"] for r in flat.groupBy("root_order").count().collect()} == {n: n + 1 for n in range(6)}


def test_only_parents_walk_up(spark, monkeypatch):
    sizes, frame = [], type(spark.range(1))
    plain = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **k: (lambda out: sizes.append(out.count()) or out)(plain(self, *a, **k)))
    raw = [("1", None, "root")] + [(str(100 + i), "1", "leaf") for i in range(20)] + [("x", "1", "text"), (None, "1", "none"), ("7", "x", "below"), ("8", "gone", "lost"), (None, None, "empty")]
    out = C.clean_areas(spark.createDataFrame(raw, "area_id string, parent_id string, name string"))
    got = {r["name"]: (r["area_id"], r["parent_id"], r["depth"], r["root_id"], r["path"]) for r in out.where("name != 'leaf'").collect()}
    assert got == {"root": (1, None, 0, 1, "1"), "text": (None, 1, 1, 1, "1/x"), "none": (None, 1, 1, 1, "1"), "below": (7, None, 2, 1, "1/x/7"),
                   "lost": (8, None, None, None, None), "empty": (None, None, 0, None, "")}
    assert sizes[0] == 2      # 1 and x; the leaves need no way of their own


def test_load_shapes_projects_the_documents_once(spark, monkeypatch):
    calls, plain = [], S.projected_vacancies
    monkeypatch.setattr(S, "projected_vacancies", lambda *a: calls.append(a) or plain(*a))
    Q.load_shapes(spark, SF_SMALL)
    assert len(calls) == 1


def test_raw_load_takes_employer_ids_from_the_loaded_table(spark, monkeypatch):
    seen, plain = [], Q.E.employer_ids
    monkeypatch.setattr(Q.E, "employer_ids", lambda v, *a: seen.append(_plan(v)) or plain(v, *a))
    Q.raw_tables(spark, SF_SMALL).collect()
    assert len(seen) == 1 and "from_json" not in seen[0]


def test_cities_gather_their_orders_without_copies_and_texts(spark):
    plan = _plan(L.metro_bodies(spark, SF_SMALL))
    below = plan[plan.index("Aggregate [o_custkey"):].split("\n", 1)[1]
    assert "explode" not in below and "station " not in below
