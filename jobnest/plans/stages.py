"""Shared stages of the vacancy flow, each a lazy DataFrame.

request plan (J3/A2/G4) -> landed list pages (S2) -> items (G7) -> details (J1)
-> projection with flags (P1) -> quarantine (X2) or page abort (X1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobnest.operators import requests as R
from jobnest.operators.trees import area_flatten
from jobnest.operators.vacancies import vacancy_project
from jobnest.plans import landing as L

# The search-term setting and the run instant used by the registered queries.
TERMS = "ring, gear, blue rod"
RUN_TS = "2024-04-23 05:05:00"
SEARCH_KEY = ["root_area", "term", "day"]
PAGE_KEY = ["root_area", "term", "day", "page"]


def projected_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 over every landed vacancy detail (good and bad rows, with ``_bad_reason``)."""
    return vacancy_project(L.landed(spark, sf_dir, "vacancies"), keep=["url"])


def good_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = projected_vacancies(spark, sf_dir)
    return p.where(F.col("_bad_reason").isNull()).drop("_bad_reason")


def area_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 over the landed area forest (one tree per customer root)."""
    return area_flatten(L.landed(spark, sf_dir, "areas"), root_order_col="root_key")


def area_to_root(flat: DataFrame) -> DataFrame:
    """area id -> its root area id (both typed)."""
    return flat.select(F.col("area_id").try_cast("bigint").alias("area"),
                       F.col("root_id").try_cast("bigint").alias("root_area"))


def placed_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vacancy that has an area, with its publication day."""
    return projected_vacancies(spark, sf_dir).where(F.col("area").isNotNull()).select(
        "id", "url", "name", "area",
        F.to_date(F.substring("published_at", 1, 10)).alias("day"))


def search_index(spark: SparkSession, sf_dir: str, flat: DataFrame | None = None) -> DataFrame:
    """What the search service sees: every vacancy with its root area and publication day."""
    flat = flat if flat is not None else area_nodes(spark, sf_dir)
    return placed_vacancies(spark, sf_dir).join(area_to_root(flat), "area")


def search_hits(spark: SparkSession, sf_dir: str, terms: str = TERMS) -> DataFrame:
    """F1 for every (area, term, day): one row per matching vacancy.

    Titles are matched before the areas' roots are looked up, so only hits are shuffled for that."""
    hits = R.search_hits(placed_vacancies(spark, sf_dir), terms, area_col="area")
    return hits.join(area_to_root(area_nodes(spark, sf_dir)), "area").where(F.col("root_area").isNotNull())


def assigned_pages(spark: SparkSession, sf_dir: str, terms: str = TERMS) -> DataFrame:
    """L1: page and position of every hit inside its search."""
    return R.assign_pages(search_hits(spark, sf_dir, terms).select(*SEARCH_KEY, "id"), SEARCH_KEY, ["id"])


def build_list_pages(spark: SparkSession, sf_dir: str, terms: str = TERMS) -> DataFrame:
    """S2 stand-in: the search service's list pages ``{found, pages, items[{url}]}`` (<= 100 items each)."""
    # both the counts and the page numbering read the hits: compute them once
    hits = search_hits(spark, sf_dir, terms).select(*SEARCH_KEY, "id", "url").checkpoint(eager=True)
    counts = R.search_counts(hits, SEARCH_KEY)
    pages = R.assign_pages(hits, SEARCH_KEY, ["id"])
    per_page = (pages.groupBy(*PAGE_KEY)
                .agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("_items")))
    body = F.to_json(F.struct(F.col("found"), F.col("pages"),
                              F.transform("_items", lambda x: F.struct(x["url"].alias("url"))).alias("items")))
    return per_page.join(counts, SEARCH_KEY).select(*PAGE_KEY, body.alias("body"))


def list_page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed list pages (built once per data set)."""
    return L.landed(spark, sf_dir, "list_pages", build_list_pages)


def page_items(spark: SparkSession, sf_dir: str, page_mode: str = "default") -> DataFrame:
    """Requested pages (G4 plan semi-joined to landed pages) -> items."""
    parsed = R.parse_list_pages(list_page_bodies(spark, sf_dir))
    plan = R.plan_requests(parsed.select(*SEARCH_KEY, "found", "pages").distinct(), page_mode)
    requested = parsed.join(plan.select(*PAGE_KEY), PAGE_KEY, "left_semi")
    return R.list_items(requested, PAGE_KEY)


def page_details(spark: SparkSession, sf_dir: str, page_mode: str = "default") -> DataFrame:
    """J1 + P1: every requested item with its projected detail and ``_bad_reason``."""
    items = page_items(spark, sf_dir, page_mode)
    joined = R.detail_lookup(items, L.landed(spark, sf_dir, "vacancies").select("url", "body"))
    # a missing detail parses to NULL and is reported as a bad 'document'
    return vacancy_project(joined, keep=[*PAGE_KEY, "pos", "url"])
