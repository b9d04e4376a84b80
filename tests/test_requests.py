"""Search list pages and request planning (FIXTURES.md §2) and id batches (§8)."""

from __future__ import annotations

import json

import pytest
from hypothesis import given, settings, strategies as st

from jobnest.operators import employers as E
from jobnest.operators import requests as R
from jobnest.operators.indexing import with_row_index


def _pages(spark, rows):
    return spark.createDataFrame(rows, "area long, term string, day string, page long, body string")


def page_body(found, pages, urls):
    return json.dumps({"found": found, "pages": pages, "items": [{"url": u} for u in urls]})


def test_plan_modes(spark):
    first = _pages(spark, [
        (1, "a", "d", 0, page_body(0, 0, [])),
        (2, "a", "d", 0, page_body(5, 1, ["u1"])),
        (3, "a", "d", 0, page_body(250, 3, ["u2"])),
        (4, "a", "d", 0, "{not json"),
    ])
    searches = R.parse_list_pages(first).select("area", "term", "day", "found", "pages")
    ref = sorted((r["area"], r["page"]) for r in R.plan_requests(searches, "reference").collect())
    assert ref == [(2, 0), (3, 1), (3, 2), (3, 3)]      # found 0 and malformed bodies plan nothing
    default = sorted((r["area"], r["page"]) for r in R.plan_requests(searches, "default").collect())
    assert default == [(2, 0), (3, 0), (3, 1), (3, 2)]


def test_items_keep_duplicates_across_terms(spark):
    pages = _pages(spark, [(1, "a", "d", 0, page_body(1, 1, ["u"])),
                           (1, "b", "d", 0, page_body(1, 1, ["u"]))])
    items = R.list_items(R.parse_list_pages(pages), ["area", "term", "day", "page"])
    details = spark.createDataFrame([("u", "{}")], "url string, body string")
    assert R.detail_lookup(items, details).count() == 2        # U1: no de-duplication


def test_duplicate_details_fail_fast(spark):
    details = spark.createDataFrame([("u", "{}"), ("u", "{}"), ("v", "{}")], "url string, body string")
    with pytest.raises(ValueError, match="duplicate url"):
        R.assert_unique_keys(details, "url")
    R.assert_unique_keys(details.where("url = 'v'"), "url")


def test_search_counts_and_pages(spark):
    index = spark.createDataFrame(
        [(i, f"x{i}", "Blue Rod" if i % 3 else "ring", 7, "2024-04-21") for i in range(250)],
        "id long, url string, name string, root_area long, day string").withColumn("day", R.F.col("day").cast("date"))
    hits = R.search_hits(index, "ring, blue rod")
    counts = {r["term"]: (r["found"], r["pages"]) for r in R.search_counts(hits).collect()}
    assert counts == {"ring": (84, 1), "blue rod": (166, 2)}
    assigned = R.assign_pages(hits, ["root_area", "term", "day"], ["id"])
    rows = [(r["id"], r["page"], r["pos"]) for r in assigned.where("term = 'blue rod'").orderBy("id").collect()]
    assert rows[0][1:] == (0, 0) and rows[99][1:] == (0, 99) and rows[100][1:] == (1, 0)
    one = R.search_filter(index, 7, "2024-04-21", "RING")
    assert one.count() == 84


def test_area_threshold(spark):
    counts = spark.createDataFrame([(1, 2000), (2, 1999)], "root_area long, found long")
    routes = {r["root_area"]: r["route"] for r in R.area_threshold(counts).collect()}
    assert routes == {1: "split", 2: "whole"}


@pytest.mark.parametrize("n", [0, 1, 500, 501, 1500])
@pytest.mark.parametrize("drop_last", [False, True])
def test_batches(spark, n, drop_last):
    ids = spark.range(n).selectExpr("id * 3 + 1 AS id")
    b = E.employer_batches(ids, 500, drop_last=drop_last).collect()
    expect = list(range(n))[:-1] if drop_last else list(range(n))
    got = sorted((r["part"], r["pos"], r["id"]) for r in b)
    assert got == [(i // 500, i % 500, i * 3 + 1) for i in expect]
    last = E.last_part(E.employer_batches(ids, 500, drop_last=drop_last)).first()["last_part"]
    assert last == ((len(expect) - 1) // 500 if expect else None)


def test_row_index_with_hot_group(spark):
    """One group holding most rows is numbered exactly, across several range partitions."""
    df = spark.range(5000).selectExpr("CASE WHEN id % 10 = 0 THEN 'cold' ELSE 'hot' END AS g", "id")
    out = with_row_index(df, ["id"], ["g"], "i", num_ranges=7)
    by_g = {}
    for r in out.collect():
        by_g.setdefault(r["g"], []).append((r["id"], r["i"]))
    for g, rows in by_g.items():
        rows.sort()
        assert [i for _, i in rows] == list(range(len(rows))), g
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@settings(max_examples=12, deadline=None)
@given(sizes=st.lists(st.integers(min_value=0, max_value=120), min_size=1, max_size=6),
       hot=st.integers(min_value=0, max_value=600), ranges=st.integers(min_value=1, max_value=9))
def test_row_index_property(spark, sizes, hot, ranges):
    """Exact 0..n-1 numbering per group in key order, whatever the group sizes and range count."""
    rows = [(f"g{g}", k * 7 % 1009 + g) for g, n in enumerate(sizes) for k in range(n)]
    rows += [("hot", k) for k in range(hot)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "g string, k long")
    got = {}
    for r in with_row_index(df, ["k"], ["g"], "i", num_ranges=ranges).collect():
        got.setdefault(r["g"], []).append((r["k"], r["i"]))
    expect = {}
    for g, k in sorted(rows):
        expect.setdefault(g, []).append(k)
    for g, ks in expect.items():
        pairs = sorted(got[g], key=lambda x: x[1])
        assert [i for _, i in pairs] == list(range(len(ks)))
        assert sorted(k for k, _ in pairs) == ks and [k for k, _ in pairs] == sorted(k for k, _ in pairs)


def test_batches_persist_as_named_parts(spark):
    """K6: one folder per part; the last part index comes back from the data."""
    import os
    from jobnest.session import local_path, work_root
    from jobnest.sinks.tables import write_batches
    ids = spark.range(1200).selectExpr("id * 2 AS id")
    path = work_root(spark, "t", "batches", unique=True)
    write_batches(E.employer_batches(ids, 500), path)
    parts = sorted(d for d in os.listdir(local_path(path)) if d.startswith("part="))
    assert parts == ["part=0", "part=1", "part=2"]
    back = spark.read.parquet(path)
    assert back.where("part = 2").count() == 200
    assert E.last_part(back).first()["last_part"] == 2


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=450), min_size=1, max_size=8))
def test_page_plan_property(spark, founds):
    """G4 + F2 against Python: default pages 0..pages-1; reference 1..pages when pages > 1, else 0."""
    rows = [(i, f, -(-f // 100)) for i, f in enumerate(founds)]
    searches = spark.createDataFrame(rows, "area long, found long, pages long")
    for mode in ("default", "reference"):
        got = sorted((r["area"], r["page"]) for r in R.plan_requests(searches, mode).collect())
        want = []
        for area, found, pages in rows:
            if found == 0:
                continue
            if mode == "default":
                want += [(area, p) for p in range(pages)]
            else:
                want += [(area, p) for p in (range(1, pages + 1) if pages > 1 else [0])]
        assert got == sorted(want), mode
