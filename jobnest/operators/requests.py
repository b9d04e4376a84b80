"""Search request planning and list pages.

The original fans out one task per (term, area), asks the search service for
``found``/``pages`` and then walks the pages.  On Spark the same plan is a
few declarative steps over whole tables:

* terms come from one comma-space setting and are attached with ``explode``
  (a generator over a parameter-sized list; no join, no cross product);
* the search predicate (area, day, title contains term) is evaluated on the
  landed vacancy index with a term-match explode and one aggregate;
* page numbers come from an exact distributed row index per search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobnest.functions.scalars import split_list_param, translate_name
from jobnest.operators.indexing import with_row_index

# Fixed values (must equal the original's): items per list page; hit count above
# which an area would be split by city.
PER_PAGE = 100
SPLIT_THRESHOLD = 1999

LIST_PAGE_SCHEMA = T.StructType([
    T.StructField("found", T.LongType()),
    T.StructField("pages", T.LongType()),
    T.StructField("items", T.ArrayType(T.StructType([T.StructField("url", T.StringType())]))),
])


def search_terms(terms: str) -> Column:
    """The comma-space separated search-term setting as an array column."""
    return split_list_param(terms)


def with_terms(df: DataFrame, terms: str, term_col: str = "term") -> DataFrame:
    """Every row once per search term (``explode`` of the parameter list)."""
    return df.select("*", F.explode(search_terms(terms)).alias(term_col),
                     ).withColumn("group_name", translate_name(F.col(term_col)))


def matching_terms(title: Column, terms: str) -> Column:
    """F1 (title part): the terms whose text occurs in the title, case-insensitive."""
    return F.filter(search_terms(terms), lambda t: F.contains(F.lower(title), F.lower(t)))


def search_hits(index: DataFrame, terms: str, area_col: str = "root_area", title_col: str = "name",
                day_col: str = "day") -> DataFrame:
    """F1 on the whole index: one row per (vacancy, matching term) with its search key."""
    return (index.where(F.col(area_col).isNotNull() & F.col(day_col).isNotNull())
            .select("*", F.explode(matching_terms(F.col(title_col), terms)).alias("term")))


def search_filter(index: DataFrame, area, day, term: str, area_col: str = "root_area",
                  title_col: str = "name", day_col: str = "day", day_to=None) -> DataFrame:
    """area equality (``None`` = every area), closed day range [day, day_to or day],
    title contains term (case-insensitive)."""
    d0 = F.lit(str(day)).cast("date")
    d1 = F.lit(str(day_to if day_to is not None else day)).cast("date")
    cond = F.col(day_col).between(d0, d1) & F.contains(F.lower(F.col(title_col)), F.lower(F.lit(term)))
    if area is not None:
        cond = cond & (F.col(area_col) == F.lit(area))
    return index.where(cond)


def search_counts(hits: DataFrame, key_cols: list[str] | None = None, per_page: int = PER_PAGE) -> DataFrame:
    """A2: per search, ``found`` and ``pages = ceil(found / per_page)``."""
    key_cols = key_cols or ["root_area", "term", "day"]
    return (hits.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("found"))
            .withColumn("pages", F.ceil(F.col("found") / F.lit(per_page)).cast("bigint")))


def answer_searches(searches: DataFrame, hits: DataFrame, key_cols: list[str], per_page: int = PER_PAGE) -> DataFrame:
    """A2 for a list of searches: as ``search_counts``, and ``found`` and ``pages`` 0 for a search without hits."""
    counts = search_counts(hits, key_cols, per_page)
    zero = F.lit(0).cast("bigint")
    return searches.join(counts, key_cols, "left").select(
        *key_cols, F.coalesce("found", zero).alias("found"), F.coalesce("pages", zero).alias("pages"))


def plan_requests(searches: DataFrame, page_mode: str = "default") -> DataFrame:
    """F2 + G4: the page requests of every non-empty search.

    ``default``   pages 0..pages-1 (every page once).
    ``reference`` as the original: pages 1..pages when pages > 1 (page 0 is only
                  the first response), else the single first page 0.
    """
    non_empty = searches.where(F.col("found") != 0)                       # F2
    if page_mode == "default":
        pages = F.sequence(F.lit(0).cast("bigint"), F.col("pages") - 1)
    elif page_mode == "reference":
        pages = (F.when(F.col("pages") > 1, F.sequence(F.lit(1).cast("bigint"), F.col("pages")))
                 .otherwise(F.array(F.lit(0).cast("bigint"))))
    else:
        raise ValueError(f"unknown page_mode: {page_mode}")
    return non_empty.select("*", F.explode(pages).alias("page"))


def assign_pages(hits: DataFrame, key_cols: list[str], order_cols: list[str],
                 per_page: int = PER_PAGE) -> DataFrame:
    """L1: page number and position of every hit inside its search (per_page items a page)."""
    idx = with_row_index(hits, order_cols=order_cols, group_cols=key_cols, index_col="_i")
    return (idx.withColumn("page", F.floor(F.col("_i") / per_page).cast("bigint"))
               .withColumn("pos", (F.col("_i") % per_page).cast("int"))
               .drop("_i"))


def area_threshold(counts: DataFrame, threshold: int = SPLIT_THRESHOLD) -> DataFrame:
    """route each search by ``found`` -- above the threshold it would be split by city."""
    return counts.withColumn("route", F.when(F.col("found") > threshold, F.lit("split"))
                             .otherwise(F.lit("whole")))


def parse_list_pages(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """Landed list-page bodies -> found, pages, items."""
    return pages.withColumn("_p", F.from_json(F.col(body_col), LIST_PAGE_SCHEMA)).select(
        "*", F.col("_p.found").alias("found"), F.col("_p.pages").alias("pages"),
        F.col("_p.items").alias("items")).drop("_p", body_col)


def list_items(parsed_pages: DataFrame, key_cols: list[str]) -> DataFrame:
    """One row per list item, keeping its position on the page."""
    return parsed_pages.select(*key_cols, F.posexplode("items").alias("pos", "item")).select(
        *key_cols, "pos", F.col("item.url").alias("url"))


def assert_unique_keys(df: DataFrame, key: str) -> None:
    """J1 precondition: one detail document per key (one aggregate over the key column)."""
    dup = (df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
           .select(key).limit(3).collect())
    if dup:
        raise ValueError(f"duplicate {key} in detail documents, e.g. {[r[key] for r in dup]}")


def detail_lookup(items: DataFrame, details: DataFrame, url_col: str = "url",
                  body_col: str = "body") -> DataFrame:
    """Per list item, its detail document by url; duplicates are kept (left join)."""
    d = details.select(F.col(url_col), F.col(body_col))
    return items.join(d, url_col, "left")
