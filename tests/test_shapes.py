"""Golden cases for the JSON shapes: area tree, metro, dictionaries, employers (FIXTURES.md §3-§6)."""

from __future__ import annotations

import json

import pytest
from hypothesis import given, settings, strategies as st

from conftest import bodies
from jobnest.operators import dictionaries as D
from jobnest.operators import employers as E
from jobnest.operators import metro as M
from jobnest.operators import trees as TR


def node(id_, parent, name, kids=None, with_areas=True):
    n = {"id": id_, "parent_id": parent, "name": name}
    if with_areas:
        n["areas"] = kids or []
    return n


def test_tree_preorder(spark):
    tree = [node("1", None, "C1", [node("2", "1", "R", [node("4", "2", "x")]), node("3", "1", "S")]),
            node("9", None, "C2")]
    flat = TR.area_flatten(bodies(spark, [tree]), body_is_array=True)
    rows = flat.orderBy("root_order", "path").collect()
    assert [(r["area_id"], r["parent_id"], r["name"]) for r in rows] == [
        ("1", None, "C1"), ("2", "1", "R"), ("4", "2", "x"), ("3", "1", "S"), ("9", None, "C2")]
    pre = {r["area_id"]: r["preorder"] for r in TR.area_preorder(flat).collect()}
    assert pre == {"1": 0, "2": 1, "4": 2, "3": 3, "9": 0}


def test_tree_missing_areas_and_field_wins(spark):
    tree = [node("1", None, "A", [node("2", "77", "B", with_areas=False)])]
    rows = TR.area_flatten(bodies(spark, [tree]), body_is_array=True).collect()
    assert sorted((r["area_id"], r["parent_id"]) for r in rows) == [("1", None), ("2", "77")]


def test_tree_depth_30(spark):
    leaf = node("30", "29", "n30")
    for i in range(29, 0, -1):
        leaf = node(str(i), str(i - 1) if i > 1 else None, f"n{i}", [leaf])
    flat = TR.area_flatten(bodies(spark, [leaf]))
    assert flat.count() == 30
    assert flat.agg({"depth": "max"}).first()[0] == 29


def test_tree_bad_bodies_give_no_nodes(spark):
    good = json.dumps(node("1", None, "A", [node("2", "1", "B")]))
    df = spark.createDataFrame([(good,), ("not json",), (None,)], "body string")
    rows = TR.area_flatten(df).collect()
    assert sorted(r["area_id"] for r in rows) == ["1", "2"]


def test_roots_and_parents(spark):
    tree = [node("1", None, "C1", [node("2", "1", "R", [node("4", "2", "x")]), node("3", "1", "S")])]
    flat = TR.area_flatten(bodies(spark, [tree]), body_is_array=True)
    assert [r["area_id"] for r in TR.area_roots(flat).collect()] == ["1"]
    assert sorted(r["area_id"] for r in TR.area_parents(flat).collect()) == ["1", "2"]


tree_strategy = st.recursive(
    st.just([]),
    lambda kids: st.lists(kids, max_size=3),
    max_leaves=25,
)


def _materialise(shape, parent=None, counter=None):
    counter = counter if counter is not None else [0]
    out = []
    for kids in shape:
        counter[0] += 1
        nid = str(counter[0])
        out.append(node(nid, parent, f"n{nid}", _materialise(kids, nid, counter)))
    return out


def _dfs(nodes, acc):
    for n in nodes:
        acc.append(n["id"])
        _dfs(n["areas"], acc)
    return acc


@settings(max_examples=15, deadline=None)
@given(tree_strategy)
def test_tree_property(spark, shape):
    tree = _materialise(shape)
    flat = TR.area_flatten(bodies(spark, [tree]), body_is_array=True).orderBy("root_order", "path")
    rows = flat.collect()
    ids = [r["area_id"] for r in rows]
    assert ids == _dfs(tree, [])                       # node count in = rows out, pre-order
    known = set(ids)
    assert all(r["parent_id"] in known for r in rows if r["parent_id"] is not None)


CITY = {"id": "1", "lines": [
    {"id": "1", "name": "L1", "hex_color": "F00", "stations": [
        {"id": "1.10", "name": "a", "lat": 1.0, "lng": 2.0, "order": 0},
        {"id": "12.345.6", "name": "b", "lat": 1.5, "lng": 2.5, "order": 1}]},
    {"id": "1", "name": "L1", "hex_color": "F00", "stations": []},
    {"id": "01", "name": "L1", "hex_color": "F00", "stations": []},
]}


def test_metro_lines_distinct_before_cast(spark):
    rows = M.metro_lines(bodies(spark, [CITY])).collect()
    assert sorted((r["metro_line_id"], r["city_id"]) for r in rows) == [(1, 1), (1, 1)]


def test_metro_stations(spark):
    rows = M.metro_stations(bodies(spark, [CITY])).orderBy("order_station").collect()
    assert [(r["metro_station_id"], r["metro_line_id"], r["lon"]) for r in rows] == [(10, 1, 2.0), (345, 1, 2.5)]


def test_metro_read_out_order(spark):
    cities = [{"id": "2", "lines": [{"id": "5", "stations": [{"id": "5.9", "order": 1}, {"id": "5.3", "order": 0}]},
                                    {"id": "1", "stations": []}]},
              {"id": "1", "lines": [{"id": "7", "stations": []}]}]
    b = bodies(spark, cities)
    assert [(r["city_id"], r["metro_line_id"]) for r in M.sorted_lines(M.metro_lines(b)).collect()] == [
        (1, 7), (2, 1), (2, 5)]                                               # O1
    assert [r["metro_station_id"] for r in M.sorted_stations(M.metro_stations(b)).collect()] == [3, 9]  # O2


@pytest.mark.parametrize("bad", [
    {"id": "1", "lines": [{"id": "1", "stations": [{"id": "nodot"}]}]},
    {"id": "1", "lines": [{"id": "1", "stations": [{"id": None}]}]},
    {"id": "1", "lines": [{"id": "1"}]},
    {"id": "1"},
    {"id": None, "lines": [{"id": "1", "stations": []}]},
])
def test_metro_fail_fast(spark, bad):
    with pytest.raises(Exception):
        M.metro_stations(bodies(spark, [bad])).collect()
        M.metro_lines(bodies(spark, [bad])).collect()


def test_dictionary_normalize(spark):
    body = {"kind": [{"z": 1, "a": {"k": 2, "m": {"x": 1}}, "l": [{"q": 1}]}, {"z": 2, "n": "x"}],
            "other": [{"id": "a"}]}
    b = bodies(spark, [body])
    keys = [r["name"] for r in D.dictionary_keys(b).orderBy("first_pos").collect()]
    assert keys == ["kind", "other"]
    out = D.dictionary_normalize(b, "kind")
    assert sorted(out.columns) == sorted(["z", "l", "a.k", "a.m.x", "n"])
    rows = sorted(out.collect(), key=lambda r: r["z"])
    assert rows[0]["a.m.x"] == 1 and json.loads(rows[0]["l"]) == [{"q": 1}]
    assert rows[1]["l"] is None and rows[1]["a.k"] is None and rows[1]["a.m.x"] is None and rows[1]["n"] == "x"


def test_dictionary_single_object_is_one_row(spark):
    b = bodies(spark, [{"one": {"id": "a", "m": {"x": 1}}, "many": [{"id": "b"}, {"id": "c"}]}])
    assert [tuple(r) for r in D.dictionary_normalize(b, "one").collect()] == [("a", 1)]
    assert D.dictionary_normalize(b, "many").count() == 2


def test_employer_project(spark):
    docs = [{"id": "5", "name": "E", "type": "company", "site_url": "s", "vacancies_url": "v",
             "area": {"id": "1"}, "open_vacancies": 3},
            {"id": "6", "name": "F", "type": "agency", "site_url": None, "vacancies_url": "v",
             "area": None, "open_vacancies": 0},
            {"errors": [{"type": "not_found"}]}]
    rows = E.employer_project(bodies(spark, docs), keep=["_i"]).orderBy("_i").collect()
    assert rows[0]["id"] == 5 and rows[0]["area_id"] == 1 and rows[0]["open_vacancies"] == 3
    assert rows[1]["area_id"] is None
    assert all(rows[2][c] is None for c in E.EMPLOYER_COLUMNS)      # all-NULL row kept


def test_employer_lookup_url_key(spark):
    ids = spark.createDataFrame([(5.0,), (9.0,)], "id double")
    docs = spark.createDataFrame([("employers/5", json.dumps({"id": "5", "name": "E"}))], "url string, body string")
    rows = {r["requested_id"]: r for r in E.employer_lookup(ids, docs).collect()}
    assert rows[5.0]["name"] == "E" and rows[9.0]["id"] is None


def test_json_array_response_as_records(spark, tmp_path_factory):
    """A whole JSON-array response read element by element gives the same rows as the body path."""
    from jobnest.session import work_root
    from jobnest.sources.landed import read_json_records
    tree = [node("1", None, "C1", [node("2", "1", "R", [node("4", "2", "x")]), node("3", "1", "S")]),
            node("9", None, "C2")]
    root = work_root(spark, "t", "records", unique=True)
    spark.createDataFrame([(json.dumps(tree, indent=2),)], "v string").coalesce(1).write.text(f"{root}/areas")
    spark.createDataFrame([(json.dumps([CITY], indent=2),)], "v string").coalesce(1).write.text(f"{root}/metro")
    recs = read_json_records(spark, f"{root}/areas", TR.NODE)
    flat = TR.area_flatten_records(recs).orderBy("root_order", "path").collect()
    assert [r["area_id"] for r in flat] == ["1", "2", "4", "3", "9"]
    cities = read_json_records(spark, f"{root}/metro", M.CITY)
    assert M.metro_stations(cities, None).count() == 2 and M.metro_lines(cities, None).count() == 2


# ---- G6 against pandas.json_normalize on random lists of objects ----
_LEAF = {"n": st.integers(-5, 5), "s": st.sampled_from(["a", "b", "c d"]), "l": st.lists(st.integers(0, 3), max_size=2)}


@st.composite
def _entries(draw):
    # each key keeps one type, as in a real dictionary; any key may be missing from an entry
    shape = {"k1": "n", "k2": "s", "k3": "l", "sub": {"x": "n", "deep": {"y": "s"}}}

    def build(sh):
        out = {}
        for key, kind in sh.items():
            if draw(st.booleans()):
                out[key] = build(kind) if isinstance(kind, dict) else draw(_LEAF[kind])
        return out
    return [build(shape) for _ in range(draw(st.integers(1, 6)))]


@settings(max_examples=8, deadline=None)
@given(_entries())
def test_dictionary_normalize_matches_json_normalize(spark, entries):
    import math
    import pandas as pd
    expected = pd.json_normalize(entries)
    out = D.dictionary_normalize(bodies(spark, [{"d": entries}]), "d")
    assert set(out.columns) == set(expected.columns)
    if not out.columns:     # no field anywhere: pandas reports no rows, Spark one empty row per entry
        return
    got = sorted([tuple(sorted(r.asDict().items())) for r in out.collect()], key=repr)

    def norm(v):
        if isinstance(v, float) and math.isnan(v):
            return None
        if isinstance(v, float) and v.is_integer():
            return int(v)
        return v
    want = []
    for rec in expected.to_dict("records"):
        row = {}
        for c in out.columns:
            v = rec.get(c)
            v = json.dumps(v, separators=(",", ":")) if isinstance(v, list) else norm(v)
            row[c] = v
        want.append(tuple(sorted(row.items())))
    assert got == sorted(want, key=repr)


# ---- G2/G3/A1 against the original's loops on random cities ----
@st.composite
def _cities(draw):
    cities = []
    for c in range(draw(st.integers(1, 4))):
        lines = []
        for _ in range(draw(st.integers(0, 3))):
            lid = draw(st.sampled_from(["1", "01", "2", "10"]))
            stations = [{"id": f"{lid}.{draw(st.integers(0, 99))}", "name": "s", "lat": 1.0, "lng": 2.0,
                         "order": draw(st.integers(0, 5))} for _ in range(draw(st.integers(0, 3)))]
            lines.append({"id": lid, "name": draw(st.sampled_from(["L", "M"])), "hex_color": "F00",
                          "stations": stations})
        cities.append({"id": str(c), "lines": lines})
    return cities


def _expected_metro(cities):
    seen, lines, stations = set(), [], []
    for city in cities:
        for line in city["lines"]:
            row = (line["id"], city["id"], line["name"], line["hex_color"])
            if row not in seen:                      # distinct on the text values, then the cast
                seen.add(row)
                lines.append((int(row[0]), int(row[1]), row[2], row[3]))
            for s in line["stations"]:
                stations.append((int(s["id"].split(".")[1]), int(line["id"]), s["order"]))
    return sorted(lines), sorted(stations)


@settings(max_examples=8, deadline=None)
@given(_cities())
def test_metro_matches_the_loops(spark, cities):
    b = bodies(spark, cities)
    lines = sorted(tuple(r) for r in M.metro_lines(b).collect())
    stations = sorted((r["metro_station_id"], r["metro_line_id"], r["order_station"])
                      for r in M.metro_stations(b).collect())
    assert (lines, stations) == _expected_metro(cities)
