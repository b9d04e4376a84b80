"""Searches with many hits: a region's vacancies of a year by term, searched, paged and looked up.

The search service is a stand-in over the landed vacancies: it answers every search of the list (region x term x year)
with pages of at most 100 items, a search without hits with one empty page.  Vacancies of finished orders of high
priority are withdrawn between search and fetch, so their detail is missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobnest.operators import requests as R
from jobnest.operators.vacancies import page_abort, vacancy_project
from jobnest.plans import landing as L
from jobnest.plans import stages as S

# The search terms (one broad, one that nothing matches) and the years searched (the last has no vacancies).
TERMS = S.TERMS + ", e, violin"
FIRST_YEAR, LAST_YEAR = 1992, 2002
KEY = ["search_area", "term", "year"]
PAGE = [*KEY, "page"]


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region once per term and year."""
    areas = L.read_table(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).cast("bigint").alias("search_area"))
    years = F.sequence(F.lit(FIRST_YEAR).cast("bigint"), F.lit(LAST_YEAR).cast("bigint"))
    return R.with_terms(areas, TERMS).select("search_area", "term", F.explode(years).alias("year"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(search_area, term, year, id, url), one row per vacancy and matching term."""
    vac = S.projected_vacancies(spark, sf_dir).where(F.col("area").isNotNull()).select(
        "id", "url", "name", F.year(F.to_date(F.substring("published_at", 1, 10))).cast("bigint").alias("year"))
    o = L.read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    c = L.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = L.read_table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_regionkey") + 1).cast("bigint").alias("search_area"))
    places = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("id", "search_area")
    return R.search_hits(vac.join(places, "id"), TERMS, day_col="year", area_col="search_area").select(*KEY, "id", "url")


def build_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 stand-in: (search_area, term, year, page, body) of every page of every search."""
    found = hits(spark, sf_dir).checkpoint(eager=True)
    counts = R.answer_searches(searches(spark, sf_dir), found, KEY)
    items = (R.assign_pages(found, KEY, ["id"]).groupBy(*PAGE)
             .agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("items")))
    pages = counts.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest("pages", F.lit(1)) - 1)).alias("page"))
    urls = F.transform(F.coalesce("items", F.array().cast("array<struct<pos:int,url:string>>")), lambda x: F.struct(x["url"].alias("url")))
    body = F.to_json(F.struct("found", "pages", urls.alias("items")))
    return pages.join(items, PAGE, "left").select(*PAGE, body.alias("body"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed pages parsed."""
    return R.parse_list_pages(L.landed(spark, sf_dir, "wide_pages", build_pages))


def first_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: what the first page of every search says."""
    return answers(spark, sf_dir).where("page = 0").select(*KEY, "found", "pages")


def items(spark: SparkSession, sf_dir: str, page_mode: str = "default") -> DataFrame:
    """G4 + G7: the items of the pages that the plan asks for; a page that does not exist has none."""
    plan = R.plan_requests(first_answers(spark, sf_dir), page_mode).select(*PAGE)
    return R.list_items(answers(spark, sf_dir).join(plan, PAGE, "left_semi"), PAGE)


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + P1: every item with its projected detail; the reason of a missing one is ``document``."""
    gone = L.read_table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_orderpriority = '2-HIGH'")
    landed = L.landed(spark, sf_dir, "vacancies")
    there = landed.join(gone.select(F.col("o_orderkey").alias("vacancy_key")), "vacancy_key", "left_anti").select("url", "body")
    joined = R.detail_lookup(items(spark, sf_dir), there).withColumn("has_detail", F.col("body").isNotNull())
    return vacancy_project(joined, keep=[*PAGE, "pos", "url", "has_detail"])


# ------------------------------------------------------------------ queries
def wide_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + S2 + A2: found and pages of every search, also of those without hits."""
    return first_answers(spark, sf_dir)


def wide_request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + G4: pages 0..pages-1 of every search with hits."""
    return R.plan_requests(first_answers(spark, sf_dir)).select(*PAGE)


def wide_request_plan_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + G4 in the original's numbering: 1..pages where there is more than one page."""
    return R.plan_requests(first_answers(spark, sf_dir), "reference").select(*PAGE)


def wide_page_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: page and position of every hit."""
    return R.assign_pages(hits(spark, sf_dir), KEY, ["id"]).select(*PAGE, "id", F.col("pos").cast("bigint").alias("pos"))


def wide_items_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 + G7: what the original's numbering reads; the first page of a search with several is not among it."""
    return items(spark, sf_dir, "reference").select(*PAGE, F.col("pos").cast("bigint").alias("pos"), "url")


def wide_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + P1: the detail of every item, or why there is none."""
    return details(spark, sf_dir).select(*PAGE, F.col("pos").cast("bigint").alias("pos"), "url", "has_detail",
                                         "id", "name", "salary_from", F.col("_bad_reason").alias("bad_reason"))


def wide_page_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 + W1: per page, the items before the first bad or missing one."""
    kept = page_abort(details(spark, sf_dir), PAGE, "pos")
    return kept.select(*PAGE, F.col("pos").cast("bigint").alias("pos"), "id")


QUERIES = {q.__name__: q for q in (wide_counts, wide_request_plan, wide_request_plan_reference, wide_page_assign,
                                   wide_items_reference, wide_details, wide_page_abort)}
