"""Registered queries: one per operator group of SURVEY §2, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the provided tables (through the landed-body stand-ins of
``jobnest.plans.landing``) in full.  Column names match ``jobnest.plans.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobnest.operators import clean as C
from jobnest.operators import dictionaries as D
from jobnest.operators import employers as E
from jobnest.operators import metro as M
from jobnest.operators import requests as R
from jobnest.operators import trees as TR
from jobnest.operators.audit import CORRUPT, metro_audit, readable
from jobnest.operators.history import merge_history
from jobnest.operators.split import split_hits, split_searches
from jobnest.operators.vacancies import VACANCY_COLUMNS, page_abort, quarantine
from jobnest.plans import landing as L
from jobnest.plans import stages as S
from jobnest.plans import wide
from jobnest.session import work_root
from jobnest.sinks.staging import accumulated, append_staging, staged_schema
from jobnest.sinks.dictionaries import load_all
from jobnest.sinks.parts import looked_up, lookup_runs, write_runs
from jobnest.sinks.tables import STATION_AUDIT_COL, load_log, log_loads, replace_load, sorted_load
from jobnest.sources.catalog import list_tables, read_table
from jobnest.sources.landed import read_bodies, read_json_records
from jobnest.sources.staging import read_staging
from jobnest.streaming.ingest import ingest_vacancies

Query = Callable[[SparkSession, str], DataFrame]


def _raw_view(df: DataFrame) -> DataFrame:
    """The 25 raw vacancy columns with key_skills joined to text for comparison."""
    return df.select(*[F.array_join("key_skills", "|").alias("key_skills") if c == "key_skills" else F.col(c)
                       for c in VACANCY_COLUMNS])


# ------------------------------------------------------------------ flagship
def vacancies_by_root_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + G1: good vacancies counted per root area of the area tree."""
    good = S.good_vacancies(spark, sf_dir)
    roots = S.area_to_root(S.area_nodes(spark, sf_dir))
    return (good.join(roots, "area")
            .groupBy(F.col("root_area").alias("root_area_id"))
            .agg(F.count(F.lit(1)).alias("vacancies"),
                 F.count("salary_from").alias("with_salary"),
                 F.min("salary_from").alias("min_salary_from"),
                 F.max("salary_from").alias("max_salary_from")))


# ------------------------------------------------------------------ vacancies
def vacancy_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 raw columns of every good document."""
    return _raw_view(S.good_vacancies(spark, sf_dir))


def vacancy_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad documents with the first failing rule."""
    p = S.projected_vacancies(spark, sf_dir)
    return p.where(F.col("_bad_reason").isNotNull()).select("id", F.col("_bad_reason").alias("bad_reason"))


def vacancy_page_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 + W1: per list page, the items before the first bad one."""
    kept = page_abort(S.page_details(spark, sf_dir), S.PAGE_KEY, "pos")
    return kept.select(*S.PAGE_KEY, F.col("pos").cast("bigint").alias("pos"), "id")


# ------------------------------------------------------------------ areas
def area_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of every tree."""
    return S.area_nodes(spark, sf_dir).select("area_id", "parent_id", "name",
                                              F.col("depth").cast("bigint").alias("depth"))


def deep_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1, P11, F5 on a forest of up to 100 levels: many passes, every node with its depth and root."""
    flat = TR.area_flatten(L.landed(spark, sf_dir, "chains", L.chain_bodies), root_order_col="root_key")
    return flat.select("area_id", "parent_id", "name", F.col("depth").cast("bigint").alias("depth"), "root_id")


def area_preorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 order: depth-first pre-order position inside each root's tree."""
    return TR.area_preorder(S.area_nodes(spark, sf_dir)).select(
        "area_id", "root_id", F.col("preorder").cast("bigint").alias("preorder"))


def area_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """areas without a parent."""
    return TR.area_roots(S.area_nodes(spark, sf_dir))


def area_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """areas that have at least one child."""
    return TR.area_parents(S.area_nodes(spark, sf_dir))


# ------------------------------------------------------------------ metro
def metro_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2, P12, A1, E3 (+O1 on read-out)."""
    return M.metro_lines(L.landed(spark, sf_dir, "metro"))


def metro_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3, P13, E4, E3 (+O2 on read-out)."""
    return M.metro_stations(L.landed(spark, sf_dir, "metro")).withColumn(
        "order_station", F.col("order_station").cast("bigint"))


def _sorted_metro(spark: SparkSession, sf_dir: str, table: str, rows: DataFrame, order: list[str]) -> DataFrame:
    schema = "raw_" + work_root(spark, unique=True).rsplit("/", 1)[-1][:12]
    sorted_load(rows, schema, table, S.RUN_TS, order)
    return read_table(spark, schema, table).drop("process_dttm")


def metro_lines_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + K2: lines stored in order, with their place in it."""
    return _sorted_metro(spark, sf_dir, "metro_lines", metro_lines(spark, sf_dir), M.LINE_ORDER)


def metro_stations_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 + K2: stations stored in order, with their place in it."""
    return _sorted_metro(spark, sf_dir, "metro_stations", metro_stations(spark, sf_dir), M.STATION_ORDER)


def body_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + X3: broken rules of damaged metro bodies, landed one body a line and as files that hold a JSON array."""
    root = work_root(spark, "scratch", "bodies", unique=True)
    damaged = L.damaged_metro(spark, sf_dir)
    L.write_lines(damaged.select(F.coalesce("cut", "body").alias("value")), f"{root}/lines")
    L.write_json_arrays(damaged.select("city_key", "body"), f"{root}/arrays", "city_key")
    lines = read_bodies(spark, f"{root}/lines", whole_text=False).withColumn("city", F.regexp_extract("body", '"name":"([^"]*)"', 1))
    records = read_json_records(spark, f"{root}/arrays", readable(M.CITY), CORRUPT).withColumn("city", F.col("name"))
    found = lambda rows, layout, body: metro_audit(rows, ["city"], body).withColumn("layout", F.lit(layout))
    both = found(lines, "lines", "body").unionByName(found(records, "array", None))
    return both.select("layout", "city", "path", "rule", F.when(F.col("rule") != "json", F.col("value")).alias("value"))


def metro_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + G3: stations read from files that hold one JSON array of cities each, element by element."""
    path = work_root(spark, "scratch", "arrays", unique=True)
    L.write_json_arrays(L.landed(spark, sf_dir, "metro"), path, "city_key")
    return M.metro_stations(read_json_records(spark, path, M.CITY), None)


# ------------------------------------------------------------------ dictionaries
def dictionary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary names, first-seen position and sizes."""
    return D.dictionary_keys(L.landed(spark, sf_dir, "dictionaries"), order_col="body_key").select(
        "name", "first_body", F.col("first_pos").cast("bigint").alias("first_pos"), "n_bodies",
        F.col("n_entries").cast("bigint").alias("n_entries"))


def dictionary_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``orders`` dictionary as dotted columns (lists kept whole)."""
    return D.dictionary_normalize(L.landed(spark, sf_dir, "dictionaries"), "orders")


def props_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6 + E1 on a JSON text column of a provided table."""
    ev = L.read_table(spark, sf_dir, "events").select("event_id", "props")
    return D.normalize_json_column(ev, "props", keep=["event_id"])


# ------------------------------------------------------------------ employers
def employer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: distinct employer ids of good vacancies."""
    return E.employer_ids(S.good_vacancies(spark, sf_dir))


def employer_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: every landed employer document projected; error bodies stay as all-NULL rows."""
    return E.employer_project(L.landed(spark, sf_dir, "employers"), keep=["employer_key"]).select(
        "employer_key", *E.EMPLOYER_COLUMNS)


def employer_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + P10: landed employers that occur in good vacancies."""
    emp = E.employer_project(L.landed(spark, sf_dir, "employers"))
    return E.employers_in_vacancies(emp, S.good_vacancies(spark, sf_dir)).select(*E.EMPLOYER_COLUMNS)


def employer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 + E5 + P10: every referenced id looked up at ``employers/{int(id)}``; error bodies -> NULLs."""
    ids = E.employer_ids(S.good_vacancies(spark, sf_dir))
    return E.employer_lookup(ids, L.landed(spark, sf_dir, "employers"))


def employer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 + E12: batches of 500 ids numbered from 0."""
    return E.employer_batches(E.employer_ids(S.good_vacancies(spark, sf_dir)), 500).select(
        F.col("part").cast("bigint").alias("part"), F.col("pos").cast("bigint").alias("pos"), "id")


def employer_batches_drop_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """as B1 with the original's drop of the last id."""
    return E.employer_batches(E.employer_ids(S.good_vacancies(spark, sf_dir)), 500, drop_last=True).select(
        F.col("part").cast("bigint").alias("part"), F.col("pos").cast("bigint").alias("pos"), "id")


def employer_last_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: index of the last batch of 500 employer ids, and how many ids were batched."""
    batches = E.employer_batches(E.employer_ids(S.good_vacancies(spark, sf_dir)), E.BATCH_SIZE)
    return batches.agg(F.max("part").cast("bigint").alias("last_part"), F.count(F.lit(1)).alias("n_ids"))


def employer_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + J2: parts looked up in up to four runs; the last one fails at first, and the second attempt asks for it alone."""
    batches = E.employer_batches(E.employer_ids(S.good_vacancies(spark, sf_dir)), E.BATCH_SIZE)
    step = -(-(E.last_part(batches).first()["last_part"] + 1) // 4)
    root = work_root(spark, "scratch", "parts", unique=True)
    write_runs(batches, f"{root}/batches", step)
    bodies, last = L.landed(spark, sf_dir, "employers"), batches.agg(F.max("id").alias("id")).first()["id"]
    found = lambda ids: E.employer_lookup(ids, bodies)
    lost = lambda ids: found(ids).withColumn("name", F.when(F.col("requested_id") == last, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    try:
        lookup_runs(spark, f"{root}/batches", f"{root}/found", lost, step)
        raise AssertionError("the broken run went through")
    except PySparkException:
        pass
    asked = lookup_runs(spark, f"{root}/batches", f"{root}/found", found, step)
    rows = looked_up(spark, f"{root}/batches", f"{root}/found", found, step)
    again = spark.read.parquet(f"{root}/batches").select(F.col("id").alias("requested_id"), F.col("part").cast("bigint").alias("part"), F.col("run").isin(asked).alias("asked_again"))
    return rows.join(again, "requested_id")


# ------------------------------------------------------------------ search requests
def search_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + F1 + A2: found and pages of every (root area, term, day) search."""
    return R.search_counts(S.search_hits(spark, sf_dir), S.SEARCH_KEY)


def search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 over the whole index: titles containing 'ring' published in 1997, every area."""
    return R.search_filter(S.search_index(spark, sf_dir), None, "1997-01-01", "ring",
                           day_to="1997-12-31").select("root_area", "day", "id", "name")


def request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + F2 + G4 (pages 0..pages-1)."""
    counts = R.search_counts(S.search_hits(spark, sf_dir), S.SEARCH_KEY)
    return R.plan_requests(counts, "default").select(*S.PAGE_KEY)


def request_plan_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 in the original's numbering (1..pages when pages > 1, else page 0)."""
    counts = R.search_counts(S.search_hits(spark, sf_dir), S.SEARCH_KEY)
    return R.plan_requests(counts, "reference").select(*S.PAGE_KEY)


def search_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + S9 + E9: every root area once per search term, with the term's group name."""
    roots = TR.area_roots(S.area_nodes(spark, sf_dir)).select(F.col("area_id").try_cast("bigint").alias("area"))
    return R.with_terms(roots, S.TERMS).select("area", "term", "group_name")


def page_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: page / position of each hit (100 per page)."""
    return S.assigned_pages(spark, sf_dir).select(*S.SEARCH_KEY, "id", "page",
                                                  F.col("pos").cast("bigint").alias("pos"))


def detail_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + G7 + J1: items of the landed list pages with their detail document found by url."""
    items = S.page_items(spark, sf_dir)
    # the answer tells whether there is a document, so a mark of it is looked up and no whole document shuffled
    there = F.when(F.col("body").isNotNull(), F.lit(True)).alias("body")
    joined = R.detail_lookup(items, L.landed(spark, sf_dir, "vacancies").select("url", there))
    return joined.select(*S.PAGE_KEY, F.col("pos").cast("bigint").alias("pos"), "url",
                         F.col("body").isNotNull().alias("has_detail"))


def area_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """route each (root area, term) by its total hits against the 1999 threshold."""
    counts = R.search_counts(S.search_hits(spark, sf_dir), ["root_area", "term"])
    return R.area_threshold(counts).select("root_area", "term", "found", "route")


def _geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(area_id, path_ids) of the tree region -> nation -> customer."""
    table = lambda t: L.read_table(spark, sf_dir, t)
    r = table("region").select((F.col("r_regionkey") + 1).alias("area_id"), F.lit(None).cast("bigint").alias("parent_id"), F.col("r_name").alias("name"))
    n = table("nation").select((F.col("n_nationkey") + 100).alias("area_id"), (F.col("n_regionkey") + 1).alias("parent_id"), F.col("n_name").alias("name"))
    c = table("customer").select((F.col("c_custkey") + 1000).alias("area_id"), (F.col("c_nationkey") + 100).alias("parent_id"), F.col("c_name").alias("name"))
    text = [F.col("area_id").cast("string"), F.col("parent_id").cast("string"), "name"]
    cleaned = C.clean_areas(r.unionByName(n).unionByName(c).select(*text))
    return cleaned.select("area_id", F.split("path", "/").cast("array<bigint>").alias("path_ids"))


def _geography_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(area, term, id): every vacancy per matching term, at its customer; some only give their nation or region."""
    vac = S.projected_vacancies(spark, sf_dir).where(F.col("area").isNotNull()).select("id", "name")
    o = L.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = L.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = L.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    at = (F.when(F.col("o_orderstatus") == "P", F.col("n_regionkey") + 1)
          .when(F.col("o_orderpriority") == "5-LOW", F.col("c_nationkey") + 100).otherwise(F.col("c_custkey") + 1000))
    places = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
              .select(F.col("o_orderkey").alias("id"), at.cast("bigint").alias("area")))
    return R.with_terms(vac, SPLIT_TERMS).where(F.contains(F.lower("name"), F.col("term"))).join(places, "id").select("area", "term", "id")


#: The search terms of the other queries, and a broad one with more hits than a search may have.
SPLIT_TERMS = S.TERMS + ", e"


def area_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """searches refined from regions to nations and customers until each one's hits fit."""
    return split_searches(_geography_hits(spark, sf_dir), _geography(spark, sf_dir)).select("area", "term", "route", "found", "pages")


def area_split_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 + L1: every hit with the one search that returns it."""
    hits, areas = _geography_hits(spark, sf_dir).checkpoint(eager=True), _geography(spark, sf_dir)
    return split_hits(hits, areas, split_searches(hits, areas)).select("id", "term", "area", "search_area")


# ------------------------------------------------------------------ staging and loads
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + S5: whole documents through the ``;`` staging text and back."""
    docs = L.read_table(spark, sf_dir, "documents")
    path = work_root(spark, "scratch", "staging", "documents", unique=True)
    append_staging(docs, path)
    return read_staging(spark, path, docs.schema)


def _staged_vacancies(spark: SparkSession, sf_dir: str, good: DataFrame | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Two daily batches with all raw columns; a missing date goes with the second."""
    good = (S.good_vacancies(spark, sf_dir) if good is None else good).select(*VACANCY_COLUMNS)
    early = F.coalesce(F.col("published_at") < F.lit("1998"), F.lit(False))
    return good, [good.where(early), good.where(~early)]


def csv_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 + U1: two daily batches appended to the staging text, then everything loaded."""
    good, batches = _staged_vacancies(spark, sf_dir)
    path = work_root(spark, "scratch", "staging", "vacancies", unique=True)
    for b in batches:
        append_staging(b, path)
    return accumulated(spark, path, staged_schema(good.schema, "csv"))


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 (+P1, X2): landed detail files picked up day by day by an availableNow stream,
    projected per micro-batch into good and quarantined rows."""
    bodies = L.landed(spark, sf_dir, "vacancies").select("url", "body")
    root = work_root(spark, "scratch", "ingest", unique=True)
    early = F.coalesce(F.get_json_object("body", "$.published_at") < F.lit("1998"), F.lit(False))
    batches = [bodies.where(early), bodies.where(~early)]
    for i, batch in enumerate(batches):
        batch.write.mode("overwrite").json(f"{root}/landing/day={i}")
        ingest_vacancies(spark, f"{root}/landing", f"{root}/good", f"{root}/bad", f"{root}/checkpoint")
    good = spark.read.parquet(f"{root}/good").select("id", F.lit(None).cast("string").alias("bad_reason"))
    bad = spark.read.parquet(f"{root}/bad").select("id", F.col("_bad_reason").alias("bad_reason"))
    return good.unionByName(bad)


def replace_load_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + K5 + A3: full-replace load; the second load replaces the first."""
    good, batches = _staged_vacancies(spark, sf_dir)
    schema = "raw_" + work_root(spark, unique=True).rsplit("/", 1)[-1][:12]
    replace_load(batches[0], schema, "vacancies", "2024-04-22 05:05:00")
    replace_load(good, schema, "vacancies", S.RUN_TS)
    return read_table(spark, schema, "vacancies").withColumn("key_skills", F.array_join("key_skills", "|"))


def versioned_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: a load that fails half-way leaves the rows of the load before it; the next one reads the table it replaces."""
    good, batches = _staged_vacancies(spark, sf_dir)
    schema = "raw_" + work_root(spark, unique=True).rsplit("/", 1)[-1][:12]
    rows = lambda df, load: df.select("id", "area", "salary_from", F.lit(load).alias("load"))
    replace_load(rows(batches[0], "first"), schema, "vacancies", S.RUN_TS)
    # the last of all rows can't be written
    last = F.col("id") == good.select(F.max("id")).scalar()
    broken = rows(good, "broken").withColumn("load", F.when(last, F.raise_error(F.lit("broken row"))).otherwise(F.col("load")))
    try:
        replace_load(broken, schema, "vacancies", S.RUN_TS)
        raise AssertionError("the broken load went through")
    except PySparkException:
        pass
    kept = read_table(spark, schema, "vacancies").drop("process_dttm")
    replace_load(kept.unionByName(rows(batches[1], "second")), schema, "vacancies", S.RUN_TS)
    return read_table(spark, schema, "vacancies").drop("process_dttm")


def clean_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two clean loads merged: rows that are new, changed, the same and gone, with their dates and flags."""
    v = S.good_vacancies(spark, sf_dir).select("id", "name", "salary_from", "salary_to", "schedule", "experience", "working_days")
    first = v.where(F.col("schedule") != "P").withColumn("salary_to", F.when(F.col("working_days").isNull(), F.col("salary_to")))
    second = v.where(F.col("experience").isNotNull())
    day1 = merge_history(None, first, "2024-04-22", ["id"])
    return merge_history(day1, second, "2024-04-23", ["id"])


def dictionary_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + G6: the content of every dictionary's table, a row for each value."""
    schema = "dict_" + work_root(spark, unique=True).rsplit("/", 1)[-1][:12]
    load_all(L.landed(spark, sf_dir, "dictionaries"), schema, S.RUN_TS)
    parts = []
    for t in list_tables(spark, schema):
        tbl = read_table(spark, schema, t).drop("process_dttm")
        values = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in tbl.columns if c != "id"])
        parts.append(tbl.select(F.lit(t).alias("table_name"), "id", F.inline(values)))
    return reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull())


def dictionary_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + S7: one raw table per dictionary name; rows and columns of each."""
    bodies = L.landed(spark, sf_dir, "dictionaries")
    schema = "dict_" + work_root(spark, unique=True).rsplit("/", 1)[-1][:12]
    load_all(bodies, schema, S.RUN_TS)
    parts = []
    for t in list_tables(spark, schema):
        tbl = read_table(spark, schema, t)
        parts.append(tbl.agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(t).alias("table_name"), "rows",
                             F.lit(len(tbl.columns)).cast("bigint").alias("columns")))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ clean
def clean_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw vacancies loaded from overlapping batches -> typed, de-duplicated clean table."""
    good = S.good_vacancies(spark, sf_dir)
    raw = good.unionByName(good.where(F.col("published_at") >= F.lit("1998")))
    cleaned, _ = C.clean_table(raw.withColumn("process_dttm", F.lit(S.RUN_TS).cast("timestamp")), "vacancies")
    return cleaned.select("id", "name", "area", "employer", "salary_from",
                          F.col("published_at").alias("published_ts"),
                          F.col("initial_created_at").alias("initial_created_ts"))


def clean_employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Looked-up employers (with error rows) -> clean rows keyed by id."""
    ids = E.employer_ids(S.good_vacancies(spark, sf_dir))
    raw = E.employer_lookup(ids, L.landed(spark, sf_dir, "employers")).drop("requested_id")
    cleaned, _ = C.clean_table(raw, "employers")
    return cleaned.select(*E.EMPLOYER_COLUMNS)


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deep forest as an adjacency list: orders in key order, cut into chains of 100; each chain hangs on its first."""
    key = F.col("o_orderkey")
    o = L.read_table(spark, sf_dir, "orders").select(key)
    spot = key % 100
    return o.select(key.cast("string").alias("area_id"),
                    F.when(spot != 0, (key - 1).cast("string")).alias("parent_id"),
                    F.concat(F.lit("order "), key.cast("string")).alias("name"))


def deep_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 on chains of up to 100 levels; what hangs below a missing order stays, without depth, root and path."""
    return C.clean_areas(_chains(spark, sf_dir)).select(
        "area_id", "parent_id", "name", F.col("depth").cast("bigint").alias("depth"), "root_id", "path")


def clean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected rows of looked-up employers (error bodies have no id) with their reason."""
    ids = E.employer_ids(S.good_vacancies(spark, sf_dir))
    raw = E.employer_lookup(ids, L.landed(spark, sf_dir, "employers"))
    _, bad = C.clean_table(raw, "employers")
    return bad.select("requested_id", "name", F.col("_bad_reason").alias("bad_reason"))


def text_id_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 + P10: areas and employers whose ids are no numbers, kept as rejects with the id and the rule.

    The third lines' areas get text ids, which then are parents without a number; rich customers' bodies a text id."""
    raw = TR.node_rows(S.area_nodes(spark, sf_dir))
    text = F.when(F.col("name") == "line 3", F.concat(F.lit("x"), F.col("area_id"))).otherwise(F.col("area_id"))
    child = raw.where("name = 'line 3'").select(F.lit(None).cast("string").alias("area_id"), F.concat(F.lit("x"), F.col("area_id")).alias("parent_id"), F.lit("stop").alias("name"))
    _, areas = C.split_areas(raw.select(text.alias("area_id"), "parent_id", "name").unionByName(child))
    bodies = L.landed(spark, sf_dir, "employers")
    rich = L.read_table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("employer_key"), F.lit(True).alias("rich"))
    odd = bodies.join(rich, "employer_key", "left").withColumn("body", F.when(F.col("rich"), F.regexp_replace("body", r'^\{"id":"?(\d+)"?', '{"id":"e$1"')).otherwise(F.col("body")))
    employers = E.employer_project(odd, flag=True).where(F.col("_bad_reason").isNotNull())
    return (areas.select(F.lit("areas").alias("table_name"), F.coalesce("area_id", "parent_id").alias("id"), F.col("_bad_reason").alias("bad_reason"))
            .unionByName(employers.select(F.lit("employers").alias("table_name"), "_ids.id", F.col("_bad_reason").alias("bad_reason"))))


def clean_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 ``clean_areas``: typed ids, depth, root and path from the raw adjacency list."""
    raw = TR.node_rows(S.area_nodes(spark, sf_dir))
    return C.clean_areas(raw).select("area_id", "parent_id", "name",
                                     F.col("depth").cast("bigint").alias("depth"), "root_id", "path")


def load_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + C1: the log of two runs: rows, columns and rejects that every load saw in its own write."""
    suffix = work_root(spark, unique=True).rsplit("/", 1)[-1][:12]
    path = work_root(spark, "scratch", "load_log", suffix)
    # read by every load of both runs, as in the daily chain
    projected = S.projected_vacancies(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    good, bad = quarantine(projected)
    good, batches = _staged_vacancies(spark, sf_dir, good)
    # both runs' clean and rejected rows come from these: one row per employer, made once
    raw = E.employer_lookup(E.employer_ids(good), L.landed(spark, sf_dir, "employers")).checkpoint(eager=True)
    for run, vacancies in (("2024-04-22", batches[0]), ("2024-04-23", good)):
        clean, rejected = C.clean_table(raw, "employers")
        stats = [replace_load(vacancies, f"log_{suffix}", "vacancies", S.RUN_TS), replace_load(clean, f"log_{suffix}", "employers", S.RUN_TS)]
        stats[0]["bad_rows"] = replace_load(bad, f"log_{suffix}", "vacancies_bad", S.RUN_TS)["rows"]
        stats[1]["bad_rows"] = replace_load(rejected, f"log_{suffix}", "employers_bad", S.RUN_TS)["rows"]
        log_loads(spark, path, run, stats, S.RUN_TS)
    projected.unpersist()
    return load_log(spark, path).withColumn("table", F.substring_index("table", ".", -1))


def _raw_load(spark: SparkSession, sf_dir: str, schema: str) -> None:
    """The whole raw load: areas, metro, dictionaries, vacancies, employers."""
    replace_load(TR.node_rows(S.area_nodes(spark, sf_dir)), schema, "areas", S.RUN_TS)
    replace_load(M.metro_lines(L.landed(spark, sf_dir, "metro")), schema, "metro_lines", S.RUN_TS)
    replace_load(M.metro_stations(L.landed(spark, sf_dir, "metro")), schema, "metro_stations", S.RUN_TS,
                 audit_col=STATION_AUDIT_COL)
    good = S.good_vacancies(spark, sf_dir)
    replace_load(good.drop("url"), schema, "vacancies", S.RUN_TS)
    loaded = read_table(spark, schema, "vacancies")   # as the daily chain: the documents are not parsed again
    replace_load(E.employer_lookup(E.employer_ids(loaded), L.landed(spark, sf_dir, "employers"))
                 .drop("requested_id"), schema, "employers", S.RUN_TS)
    load_all(L.landed(spark, sf_dir, "dictionaries"), schema, S.RUN_TS)


def _table_counts(spark: SparkSession, schema: str) -> DataFrame:
    parts = [read_table(spark, schema, t).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(t).alias("table_name"), "rows") for t in list_tables(spark, schema)]
    return reduce(DataFrame.unionByName, parts)


def raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + K2 + K3: the whole raw load, then every raw table listed with its row count."""
    schema = "raw_" + work_root(spark, unique=True).rsplit("/", 1)[-1][:12]
    _raw_load(spark, sf_dir, schema)
    return _table_counts(spark, schema)


def clean_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2 over every raw table (flows.clean_all), then every clean table with its row count."""
    from jobnest.plans.flows import RunConfig, clean_all
    suffix = work_root(spark, unique=True).rsplit("/", 1)[-1][:12]
    cfg = RunConfig(run_date="2024-04-23", run_ts=S.RUN_TS, raw_schema=f"raw_{suffix}",
                    clean_schema=f"clean_{suffix}")
    _raw_load(spark, sf_dir, cfg.raw_schema)
    clean_all(spark, cfg)
    return _table_counts(spark, cfg.clean_schema)


QUERIES: dict[str, Query] = {
    "vacancies_by_root_area": vacancies_by_root_area,
    "vacancy_project": vacancy_project,
    "vacancy_quarantine": vacancy_quarantine,
    "vacancy_page_abort": vacancy_page_abort,
    "area_flatten": area_flatten,
    "area_preorder": area_preorder,
    "area_roots": area_roots,
    "area_parents": area_parents,
    "metro_lines": metro_lines,
    "metro_stations": metro_stations,
    "metro_lines_sorted": metro_lines_sorted,
    "metro_stations_sorted": metro_stations_sorted,
    "body_audit": body_audit,
    "metro_records": metro_records,
    "load_shapes": load_shapes,
    "dictionary_keys": dictionary_keys,
    "dictionary_normalize": dictionary_normalize,
    "props_normalize": props_normalize,
    "employer_ids": employer_ids,
    "employer_project": employer_project,
    "employer_semi": employer_semi,
    "employer_lookup": employer_lookup,
    "employer_batches": employer_batches,
    "employer_batches_drop_last": employer_batches_drop_last,
    "employer_last_part": employer_last_part,
    "employer_parts": employer_parts,
    "search_counts": search_counts,
    "search_groups": search_groups,
    "search_filter": search_filter,
    "request_plan": request_plan,
    "request_plan_reference": request_plan_reference,
    "page_assign": page_assign,
    "detail_lookup": detail_lookup,
    "area_threshold": area_threshold,
    "area_split": area_split,
    "area_split_hits": area_split_hits,
    "versioned_load": versioned_load,
    "clean_history": clean_history,
    "dictionary_rows": dictionary_rows,
    "csv_roundtrip": csv_roundtrip,
    "csv_accumulate": csv_accumulate,
    "incremental_ingest": incremental_ingest,
    "replace_load": replace_load_query,
    "dictionary_tables": dictionary_tables,
    "raw_tables": raw_tables,
    "clean_vacancies": clean_vacancies,
    "clean_employers": clean_employers,
    "clean_areas": clean_areas,
    "deep_flatten": deep_flatten,
    "deep_areas": deep_areas,
    "clean_rejects": clean_rejects,
    "text_id_rejects": text_id_rejects,
    "clean_tables": clean_tables,
    **wide.QUERIES,
}
