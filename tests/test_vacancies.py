"""Golden documents for the vacancy projection rules (FIXTURES.md §1)."""

from __future__ import annotations

import copy

import pytest
from hypothesis import given, settings, strategies as st

from conftest import bodies
from jobnest.operators.vacancies import VACANCY_COLUMNS, page_abort, quarantine, vacancy_project

BASE = {
    "id": "101", "relations": [], "name": 'data; "engineer"\nII', "area": {"id": "1"},
    "salary": {"from": 100, "to": None}, "type": {"id": "open"}, "experience": {"id": "e1"},
    "schedule": {"id": "s1"}, "employment": {"id": "full"}, "description": "<p>text</p>",
    "key_skills": [{"name": "SQL"}, {"name": "Spark"}], "archived": False,
    "specializations": [{"id": "9"}], "professional_roles": [{"id": "156"}, {"id": "10"}],
    "employer": {"id": "7"}, "published_at": "2024-04-22T10:00:00+0300",
    "created_at": "2024-04-22T10:00:00+0300", "initial_created_at": "2024-04-20T10:00:00+0300",
    "working_days": [{"id": "sat"}], "working_time_intervals": [], "working_time_modes": None,
    "languages": [{"id": "eng", "level": {"id": "b2"}}], "approved": True,
}


def doc(id_: str, **changes):
    d = copy.deepcopy(BASE)
    d["id"] = id_
    for k, v in changes.items():
        if v is _DROP:
            d.pop(k, None)
        else:
            d[k] = v
    return d


_DROP = object()

DOCS = [
    doc("101"),
    doc("102", salary=None, key_skills=[], working_days=[], languages=[]),
    doc("103", salary={}, employer={"id": None}, type=None, languages=_DROP, approved=_DROP, relations=_DROP),
    doc("104", experience=_DROP),
    doc("105", professional_roles=[]),
    doc("106", languages=[{"id": "eng"}]),
    doc("107", key_skills=None),
    doc("108", key_skills=[{"x": 1}]),
    doc("109", employer=None),
    doc("110", area=None),
    doc("111", professional_roles=None),
    doc("112", experience={}),
]

EXPECTED_BAD = {
    104: "experience", 105: "professional_roles", 106: "languages_level", 107: "key_skills",
    108: "key_skills", 109: "employer", 110: "area", 111: "professional_roles",
}


@pytest.fixture(scope="module")
def projected(spark):
    return {r["id"]: r for r in vacancy_project(bodies(spark, DOCS)).collect()}


def test_column_order(spark):
    out = vacancy_project(bodies(spark, DOCS[:1]))
    assert out.columns == VACANCY_COLUMNS + ["_bad_reason"]


def test_verdicts(projected):
    for i in range(101, 113):
        assert projected[i]["_bad_reason"] == EXPECTED_BAD.get(i), i


def test_base_values(projected):
    r = projected[101]
    assert r["salary_from"] == 100.0 and r["salary_to"] is None
    assert r["professional_roles"] == "156"
    assert r["key_skills"] == ["SQL", "Spark"]
    assert r["working_days"] == "sat" and r["languages"] == "eng" and r["languages_level"] == "b2"
    assert r["relations"] == "[]" and r["specializations"] == '[{"id":"9"}]'
    assert r["name"] == 'data; "engineer"\nII'
    assert r["area"] == 1 and r["employer"] == 7 and r["approved"] is True


def test_empty_lists_are_lenient(projected):
    r = projected[102]
    assert r["salary_from"] is None and r["key_skills"] == []
    assert r["working_days"] is None and r["languages"] is None and r["languages_level"] is None


def test_nulls_and_empty_objects(projected):
    r = projected[103]
    assert r["salary_from"] is None and r["employer"] is None and r["type"] is None
    assert r["languages"] is None and r["approved"] is None and r["relations"] is None
    assert projected[112]["experience"] is None and projected[112]["_bad_reason"] is None


def test_not_json_is_bad(spark):
    out = vacancy_project(bodies(spark, ["not json", "[1, 2]"])).collect()
    assert [r["_bad_reason"] for r in out] == ["document", "document"]


def test_quarantine_and_page_abort(spark):
    page = [DOCS[0], DOCS[3], DOCS[1]]  # 101, 104, 102 on one page
    df = bodies(spark, page, page="p1", pos=[0, 1, 2])
    projected = vacancy_project(df, keep=["page", "pos"])
    good, bad = quarantine(projected)
    assert sorted(r["id"] for r in good.collect()) == [101, 102]
    assert [r["id"] for r in bad.collect()] == [104]
    kept = page_abort(projected, ["page"], "pos").collect()
    assert [r["id"] for r in kept] == [101]


def test_page_abort_is_per_page(spark):
    docs = [DOCS[3], DOCS[0], DOCS[0], DOCS[1]]
    df = bodies(spark, docs, page=["a", "a", "b", "b"], pos=[0, 1, 0, 1])
    kept = page_abort(vacancy_project(df, keep=["page", "pos"]), ["page"], "pos").collect()
    assert sorted((r["page"], r["pos"]) for r in kept) == [("b", 0), ("b", 1)]


def test_parse_runs_once(spark):
    """Filters on projected columns must not be pushed below the parse (plan test)."""
    good, _ = quarantine(vacancy_project(bodies(spark, DOCS)))
    plan = good.where("area IS NOT NULL")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


# ---- property test: random documents against a plain-Python statement of the rules ----
MISSING = object()


def _id_obj():
    return st.sampled_from([MISSING, None, {}, {"id": "x1"}, {"id": None}])


def _id_list():
    return st.sampled_from([MISSING, None, [], [None], [{"id": "a"}], [{}], [{"id": "a"}, {"id": "b"}]])


def _skills():
    return st.sampled_from([MISSING, None, [], [{"name": "SQL"}], [{"name": "SQL"}, {"x": 1}],
                            [None], [{"name": None}], [{"name": "a"}, {"name": "b"}]])


def _langs():
    return st.sampled_from([MISSING, None, [], [None], [{"id": "eng"}], [{"id": "eng", "level": None}],
                            [{"id": "eng", "level": {}}], [{"id": "eng", "level": {"id": "b2"}}]])


def _salary():
    return st.sampled_from([MISSING, None, {}, {"from": 10.0}, {"from": 10.0, "to": 20.0}, {"to": 5.0}])


DOC = st.fixed_dictionaries({
    "id": st.sampled_from([MISSING, MISSING, MISSING, "abc"]),
    "area": st.sampled_from([MISSING, None, {}, {"id": "x1"}, {"id": "5"}, {"id": None}]), "salary": _salary(), "type": _id_obj(), "experience": _id_obj(),
    "schedule": _id_obj(), "employment": _id_obj(), "key_skills": _skills(),
    "professional_roles": _id_list(), "employer": st.sampled_from([MISSING, None, {}, {"id": "7"}, {"id": "e7"}]),
    "working_days": _id_list(), "working_time_intervals": _id_list(), "working_time_modes": _id_list(),
    "languages": _langs(),
})


def _expected(d):
    """The original's access sequence: the first access that would raise names the reason."""
    g = d.get

    def text(x):
        return x is not None and not x.isdigit()
    if text(g("id")):                       # DECISION: an id that is no number is bad, not NULL
        return "cast:id", None
    if g("area") is None:
        return "area", None
    if text(g("area").get("id")):
        return "cast:area", None
    for f in ("experience", "schedule", "employment"):
        if g(f) is None:
            return f, None
    ks = g("key_skills")
    if ks is None or any(k is None or k.get("name") is None for k in ks):   # DECISION: null name is bad too
        return "key_skills", None
    roles = g("professional_roles")
    if not roles or roles[0] is None:
        return "professional_roles", None
    if g("employer") is None:
        return "employer", None
    if text(g("employer").get("id")):
        return "cast:employer", None
    for f in ("working_days", "working_time_intervals", "working_time_modes", "languages"):
        v = g(f)
        if v and v[0] is None:
            return f, None
    langs = g("languages")
    if langs and langs[0].get("level") is None:
        return "languages_level", None
    sal = g("salary") or None

    def first(f):
        v = g(f)
        return v[0].get("id") if v else None
    emp = g("employer").get("id")
    return None, {
        "area": None, "salary_from": sal.get("from") if sal else None, "salary_to": sal.get("to") if sal else None,
        "type": (g("type") or {}).get("id"), "experience": g("experience").get("id"),
        "key_skills": [k["name"] for k in ks], "professional_roles": roles[0].get("id"),
        "employer": int(emp) if emp is not None else None, "working_days": first("working_days"),
        "working_time_intervals": first("working_time_intervals"),
        "working_time_modes": first("working_time_modes"), "languages": first("languages"),
        "languages_level": langs[0]["level"].get("id") if langs else None,
    }


@settings(max_examples=6, deadline=None)
@given(st.lists(DOC, min_size=20, max_size=40))
def test_rules_match_plain_python(spark, docs):
    full = []
    for i, d in enumerate(docs):
        body = {k: v for k, v in d.items() if v is not MISSING}
        body.setdefault("id", str(i))
        full.append(body)
    got = {r["_i"]: r for r in vacancy_project(bodies(spark, full), keep=["_i"]).collect()}
    for i, d in enumerate(full):
        reason, values = _expected(d)
        r = got[i]
        assert r["_bad_reason"] == reason, (d, r["_bad_reason"])
        if values:
            for k, v in values.items():
                if k != "area":
                    assert r[k] == v, (k, d, r[k])
