"""Vacancy document projection (P1-P9) with strict/lenient rules and error handling.

A vacancy document is parsed once with an explicit schema (column pruning
happens inside ``from_json``) and projected to the 25 raw columns in the fixed
order.  Every *strict* access of the original record becomes a boolean check;
the first failing check (in column order, as the original code would raise)
is reported in ``_bad_reason``.  Rows are never dropped here: the caller picks
``quarantine`` (X2, default) or ``abort_page`` (X1) semantics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from jobnest.functions.json import CORRUPT, parse_body, parse_once
from jobnest.functions.nested import all_present, first_id, first_nested_id, flag, pluck

_ID = T.StructType([T.StructField("id", T.StringType())])
_ID_LIST = T.ArrayType(_ID)

VACANCY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("relations", T.StringType()),          # P9: raw list kept as JSON text
    T.StructField("name", T.StringType()),
    T.StructField("area", _ID),
    T.StructField("salary", T.StructType([T.StructField("from", T.DoubleType()),
                                          T.StructField("to", T.DoubleType())])),
    T.StructField("type", _ID),
    T.StructField("experience", _ID),
    T.StructField("schedule", _ID),
    T.StructField("employment", _ID),
    T.StructField("description", T.StringType()),
    T.StructField("key_skills", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("archived", T.BooleanType()),
    T.StructField("specializations", T.StringType()),    # P9
    T.StructField("professional_roles", _ID_LIST),
    T.StructField("employer", _ID),
    T.StructField("published_at", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("initial_created_at", T.StringType()),
    T.StructField("working_days", _ID_LIST),
    T.StructField("working_time_intervals", _ID_LIST),
    T.StructField("working_time_modes", _ID_LIST),
    T.StructField("languages", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("level", _ID)]))),
    T.StructField("approved", T.BooleanType()),
])

# Fixed values (must equal the original's): the raw vacancies columns, in order.
VACANCY_COLUMNS = [
    "id", "relations", "name", "area", "salary_from", "salary_to", "type", "experience",
    "schedule", "employment", "description", "key_skills", "archived", "specializations",
    "professional_roles", "employer", "published_at", "created_at", "initial_created_at",
    "working_days", "working_time_intervals", "working_time_modes", "languages",
    "languages_level", "approved",
]


def _projection(v: Column) -> list[Column]:
    return [
        v["id"].try_cast("bigint").alias("id"),
        v["relations"].alias("relations"),
        v["name"].alias("name"),
        v["area"]["id"].try_cast("bigint").alias("area"),                # P2 (flag below)
        v["salary"]["from"].alias("salary_from"),                         # P4: {} / null -> NULL
        v["salary"]["to"].alias("salary_to"),
        v["type"]["id"].alias("type"),                                    # P3
        v["experience"]["id"].alias("experience"),                        # P2
        v["schedule"]["id"].alias("schedule"),
        v["employment"]["id"].alias("employment"),
        v["description"].alias("description"),
        pluck(v["key_skills"], "name").alias("key_skills"),               # P8
        v["archived"].alias("archived"),
        v["specializations"].alias("specializations"),
        first_id(v["professional_roles"]).alias("professional_roles"),   # P6
        v["employer"]["id"].try_cast("bigint").alias("employer"),
        v["published_at"].alias("published_at"),
        v["created_at"].alias("created_at"),
        v["initial_created_at"].alias("initial_created_at"),
        first_id(v["working_days"]).alias("working_days"),               # P5
        first_id(v["working_time_intervals"]).alias("working_time_intervals"),
        first_id(v["working_time_modes"]).alias("working_time_modes"),
        first_id(v["languages"]).alias("languages"),
        first_nested_id(v["languages"], "level").alias("languages_level"),  # P7
        v["approved"].alias("approved"),
    ]


def _first_present(arr: Column) -> Column:
    """Strict ``lst[0].get(...)`` when the list is non-empty: the element must exist."""
    return flag(F.size(arr) == 0, True) | F.get(arr, 0).isNotNull()


def _casts(c: Column) -> Column:
    """A text id that is there must be a number; it is not turned into NULL silently."""
    return c.isNull() | c.try_cast("bigint").isNotNull()


def _bad_reason(v: Column) -> Column:
    """First failing strict rule, in source order; NULL when the document is good."""
    checks: list[tuple[str, Column]] = [
        ("document", v.isNotNull() & v[CORRUPT].isNull()),
        ("cast:id", _casts(v["id"])),
        ("area", v["area"].isNotNull()),
        ("cast:area", _casts(v["area"]["id"])),
        ("experience", v["experience"].isNotNull()),
        ("schedule", v["schedule"].isNotNull()),
        ("employment", v["employment"].isNotNull()),
        ("key_skills", v["key_skills"].isNotNull() & all_present(v["key_skills"], "name")),
        ("professional_roles", flag(F.size(v["professional_roles"]) > 0)
         & F.get(v["professional_roles"], 0).isNotNull()),
        ("employer", v["employer"].isNotNull()),
        ("cast:employer", _casts(v["employer"]["id"])),
        ("working_days", _first_present(v["working_days"])),
        ("working_time_intervals", _first_present(v["working_time_intervals"])),
        ("working_time_modes", _first_present(v["working_time_modes"])),
        ("languages", _first_present(v["languages"])),
        ("languages_level", flag(F.size(v["languages"]) == 0, True)
         | F.get(v["languages"], 0)["level"].isNotNull()),
    ]
    expr = F.lit(None).cast("string")
    for name, ok in reversed(checks):
        expr = F.when(~flag(ok), F.lit(name)).otherwise(expr)
    return expr


def vacancy_project(df: DataFrame, body_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Nested document -> 25 raw columns (fixed order) + ``_bad_reason``.

    ``keep`` carries extra input columns through (page keys, positions, urls).
    """
    return parse_once(df, parse_body(body_col, VACANCY_SCHEMA, keep_corrupt=True),
                      lambda v: [*_projection(v), _bad_reason(v).alias("_bad_reason")], keep)


def quarantine(projected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """X2 (default ``on_error='quarantine'``): good rows, and bad rows with their reason."""
    good = projected.where(F.col("_bad_reason").isNull()).drop("_bad_reason")
    bad = projected.where(F.col("_bad_reason").isNotNull())
    return good, bad


def page_abort(projected: DataFrame, page_cols: list[str], pos_col: str) -> DataFrame:
    """X1 + W1 (``on_error='abort_page'``): keep each page's items before its first bad one.

    The window is partitioned by page; a page holds at most ``per_page`` items, so
    no partition of the window grows with the data.
    """
    w = (Window.partitionBy(*page_cols).orderBy(pos_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen_bad = F.max(F.col("_bad_reason").isNotNull().cast("int")).over(w)
    return (projected.withColumn("_seen_bad", seen_bad)
            .where(F.col("_seen_bad") == 0).drop("_seen_bad", "_bad_reason"))


def apply_on_error(projected: DataFrame, on_error: str = "quarantine",
                   page_cols: list[str] | None = None, pos_col: str | None = None) -> DataFrame:
    if on_error == "quarantine":
        return quarantine(projected)[0]
    if on_error == "abort_page":
        if not page_cols or not pos_col:
            raise ValueError("abort_page needs page_cols and pos_col")
        return page_abort(projected, page_cols, pos_col)
    raise ValueError(f"unknown on_error mode: {on_error}")
