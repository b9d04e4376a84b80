"""Independent DuckDB oracles: plain SQL over the flat tables, never over the JSON.

The fixture rules of ``jobnest.plans.landing`` (which orders carry null, empty
or missing fields) are restated here in SQL; everything else is the plain
relational meaning of each operator.
"""

from __future__ import annotations

TERMS_SQL = "(VALUES ('ring'), ('gear'), ('blue rod')) AS t(term)"

BASE = """
WITH li AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, p.p_name
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
), agg AS (
  SELECT l_orderkey,
         first(p_name ORDER BY l_linenumber, l_partkey, l_suppkey) AS first_name,
         string_agg(p_name, '|' ORDER BY l_linenumber, l_partkey, l_suppkey) AS skills,
         max(CASE WHEN l_quantity = 50 THEN 1 ELSE 0 END) AS bad_skill
  FROM li GROUP BY l_orderkey
), v AS (
  SELECT o.*, c.c_nationkey, a.first_name, a.skills,
    CASE
      WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '4-NOT SPECIFIED' THEN 'area'
      WHEN o.o_orderstatus = 'F' AND o.o_orderpriority = '5-LOW' THEN 'experience'
      WHEN (a.l_orderkey IS NULL AND o.o_orderstatus = 'F') OR coalesce(a.bad_skill, 0) = 1 THEN 'key_skills'
      WHEN o.o_orderpriority = '4-NOT SPECIFIED' AND o.o_orderstatus IN ('O', 'F') THEN 'professional_roles'
      WHEN o.o_orderstatus = 'O' AND o.o_orderpriority = '3-MEDIUM' THEN 'employer'
      WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '2-HIGH' THEN 'cast:employer'
      WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW' THEN 'languages_level'
    END AS bad_reason
  FROM orders o
  LEFT JOIN agg a ON o.o_orderkey = a.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
), good AS (
  SELECT
    o_orderkey AS id,
    CASE WHEN o_orderstatus = 'F' THEN '["got_response"]' ELSE '[]' END AS relations,
    coalesce(first_name, 'untitled') AS name,
    o_orderkey * 10 + 2 AS area,
    CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
         THEN NULL ELSE o_totalprice END AS salary_from,
    CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
              OR o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice + 1000.0 END AS salary_to,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE 'open' END AS type,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN NULL
         ELSE 'exp' || substr(o_orderpriority, 1, 1) END AS experience,
    o_orderstatus AS schedule,
    'full' AS employment,
    'Order ' || CAST(o_orderkey AS VARCHAR) || '; "' || o_orderpriority || '"' || chr(10)
      || 'status ' || o_orderstatus AS description,
    coalesce(skills, '') AS key_skills,
    o_orderstatus = 'F' AS archived,
    '[{"id":"' || o_orderpriority || '"}]' AS specializations,
    CAST(c_nationkey AS VARCHAR) AS professional_roles,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_custkey END AS employer,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+0300') AS published_at,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+0300') AS created_at,
    strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S+0300') AS initial_created_at,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'sat' END AS working_days,
    CASE WHEN o_orderstatus = 'O' THEN 'four_to_six_hours' END AS working_time_intervals,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'after_sixteen' END AS working_time_modes,
    CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'eng' END AS languages,
    CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'b2' END AS languages_level,
    o_orderstatus <> 'P' AS approved,
    o_orderdate, o_custkey, o_orderkey, o_orderstatus, o_orderpriority
  FROM v WHERE bad_reason IS NULL
), idx AS (
  SELECT o_orderkey AS id, 'vacancies/' || CAST(o_orderkey AS VARCHAR) AS url,
         coalesce(first_name, 'untitled') AS name, o_custkey * 10 + 1 AS root_area,
         CAST(o_orderdate AS DATE) AS day, bad_reason
  FROM v WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED')
), hits AS (
  SELECT idx.*, t.term FROM idx, """ + TERMS_SQL + """
  WHERE contains(lower(idx.name), lower(t.term))
), counts AS (
  SELECT root_area, term, day, count(*) AS found, CAST(ceil(count(*) / 100.0) AS BIGINT) AS pages
  FROM hits GROUP BY root_area, term, day
), paged AS (
  SELECT h.*, (row_number() OVER (PARTITION BY root_area, term, day ORDER BY id) - 1) AS i FROM hits h
), pg AS (
  SELECT root_area, term, day, id, url, bad_reason, CAST(i // 100 AS BIGINT) AS page, CAST(i % 100 AS BIGINT) AS pos
  FROM paged
), emp_ids AS (
  SELECT DISTINCT employer AS id FROM good WHERE employer IS NOT NULL
), emp_open AS (
  SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey
), emp AS (
  SELECT c.c_custkey AS id, c.c_name AS name, c.c_mktsegment AS type,
         'site/' || CAST(c.c_custkey AS VARCHAR) AS site_url,
         'vacancies?employer_id=' || CAST(c.c_custkey AS VARCHAR) AS vacancies_url,
         CASE WHEN c.c_mktsegment <> 'AUTOMOBILE' THEN CAST(c.c_nationkey AS BIGINT) END AS area_id,
         CAST(coalesce(eo.n, 0) AS BIGINT) AS open_vacancies
  FROM customer c LEFT JOIN emp_open eo ON c.c_custkey = eo.o_custkey
  WHERE c.c_acctbal >= 0
), nodes AS (
  SELECT CAST(c_custkey * 10 + 1 AS VARCHAR) AS area_id, CAST(NULL AS VARCHAR) AS parent_id,
         c_name AS name, CAST(0 AS BIGINT) AS depth, CAST(c_custkey * 10 + 1 AS VARCHAR) AS root_id,
         c_custkey AS ck, CAST(-1 AS BIGINT) AS ok, 0 AS ln, CAST(-1 AS BIGINT) AS pk, CAST(-1 AS BIGINT) AS sk
  FROM customer
  UNION ALL
  SELECT CAST(o_orderkey * 10 + 2 AS VARCHAR), CAST(o_custkey * 10 + 1 AS VARCHAR),
         'order ' || CAST(o_orderkey AS VARCHAR), 1, CAST(o_custkey * 10 + 1 AS VARCHAR),
         o_custkey, o_orderkey, 0, -1, -1
  FROM orders
  UNION ALL
  SELECT CAST((l_orderkey * 10 + l_linenumber) * 10 + 3 AS VARCHAR), CAST(l_orderkey * 10 + 2 AS VARCHAR),
         'line ' || CAST(l_linenumber AS VARCHAR), 2, CAST(o.o_custkey * 10 + 1 AS VARCHAR),
         o.o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)
"""


SPLIT_BASE = """
, ghits AS (
  SELECT i.id, t.term, CAST(CASE WHEN o_orderstatus = 'P' THEN n_regionkey + 1 WHEN o_orderpriority = '5-LOW' THEN c_nationkey + 100 ELSE c_custkey + 1000 END AS BIGINT) AS area
  FROM idx i JOIN orders ON o_orderkey = i.id JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey,
       (VALUES ('ring'), ('gear'), ('blue rod'), ('e')) AS t(term)
  WHERE contains(lower(i.name), t.term)
), up AS (
  SELECT c_custkey + 1000 AS area, c_nationkey + 100 AS parent FROM customer
  UNION ALL SELECT n_nationkey + 100, n_regionkey + 1 FROM nation UNION ALL SELECT r_regionkey + 1, NULL FROM region
), gown AS (SELECT area, term, count(*) AS own FROM ghits GROUP BY area, term
), gall AS (
  SELECT area, term, own, own AS found FROM gown
  UNION ALL SELECT u.parent, term, 0, own FROM gown JOIN up u USING (area) WHERE u.parent IS NOT NULL
  UNION ALL SELECT w.parent, term, 0, own FROM gown JOIN up u USING (area) JOIN up w ON w.area = u.parent WHERE w.parent IS NOT NULL
), gfound AS (
  SELECT g.area, g.term, CAST(sum(own) AS BIGINT) AS own, CAST(sum(found) AS BIGINT) AS found, any_value(up.parent) AS parent FROM gall g JOIN up USING (area) GROUP BY g.area, g.term
), routes AS (
  SELECT CAST(f.area AS BIGINT) AS area, f.term, unnest(CASE
      WHEN f.found <= 1999 THEN [{'route': 'whole', 'found': f.found}]
      WHEN f.found = f.own THEN [{'route': 'over', 'found': f.found}]
      WHEN f.own = 0 THEN [{'route': 'split', 'found': f.found}]
      ELSE [{'route': 'split', 'found': f.found}, {'route': CASE WHEN f.own > 1999 THEN 'over' ELSE 'own' END, 'found': f.own}] END, recursive := true)
  FROM gfound f LEFT JOIN gfound p ON p.area = f.parent AND p.term = f.term WHERE f.parent IS NULL OR p.found > 1999
)
"""

WIDE_BASE = """
, whits AS (
  SELECT CAST(n_regionkey + 1 AS BIGINT) AS search_area, t.term, CAST(year(i.day) AS BIGINT) AS year, i.id, i.url, i.name,
         o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AS gone, i.bad_reason
  FROM idx i JOIN orders ON o_orderkey = i.id JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey,
       (VALUES ('ring'), ('gear'), ('blue rod'), ('e'), ('violin')) AS t(term)
  WHERE contains(lower(i.name), t.term)
), wcounts AS (
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS search_area, t.term, CAST(y.year AS BIGINT) AS year, count(h.id) AS found, CAST(ceil(count(h.id) / 100.0) AS BIGINT) AS pages
  FROM region CROSS JOIN (VALUES ('ring'), ('gear'), ('blue rod'), ('e'), ('violin')) AS t(term) CROSS JOIN range(1992, 2003) AS y(year)
       LEFT JOIN whits h ON h.search_area = r_regionkey + 1 AND h.term = t.term AND h.year = y.year
  GROUP BY r_regionkey, t.term, y.year
), wn AS (
  SELECT *, row_number() OVER (PARTITION BY search_area, term, year ORDER BY id) - 1 AS i FROM whits
), wpg AS (
  SELECT search_area, term, year, CAST(i // 100 AS BIGINT) AS page, CAST(i % 100 AS BIGINT) AS pos, url, NOT gone AS has_detail,
         CASE WHEN NOT gone THEN id END AS id, CASE WHEN NOT gone THEN name END AS name,
         CASE WHEN gone THEN 'document' ELSE bad_reason END AS bad_reason, id AS hit
  FROM wn
)
"""


def _q(body: str) -> str:
    return BASE + body


ORACLES: dict[str, str] = {
    "vacancies_by_root_area": _q("""
SELECT o_custkey * 10 + 1 AS root_area_id, count(*) AS vacancies, count(salary_from) AS with_salary,
       min(salary_from) AS min_salary_from, max(salary_from) AS max_salary_from
FROM good GROUP BY o_custkey"""),
    "vacancy_project": _q("""
SELECT id, relations, name, area, salary_from, salary_to, type, experience, schedule, employment,
       description, key_skills, archived, specializations, professional_roles, employer, published_at,
       created_at, initial_created_at, working_days, working_time_intervals, working_time_modes,
       languages, languages_level, approved
FROM good"""),
    "vacancy_quarantine": _q("SELECT o_orderkey AS id, bad_reason FROM v WHERE bad_reason IS NOT NULL"),
    "vacancy_page_abort": _q("""
, firstbad AS (
  SELECT root_area, term, day, page, min(pos) FILTER (WHERE bad_reason IS NOT NULL) AS fb
  FROM pg GROUP BY root_area, term, day, page)
SELECT p.root_area, p.term, p.day, p.page, p.pos, p.id
FROM pg p JOIN firstbad f USING (root_area, term, day, page)
WHERE f.fb IS NULL OR p.pos < f.fb"""),
    "area_flatten": _q("SELECT area_id, parent_id, name, depth FROM nodes"),
    "area_preorder": _q("""
SELECT area_id, root_id,
       row_number() OVER (PARTITION BY ck ORDER BY ok, ln, pk, sk) - 1 AS preorder
FROM nodes"""),
    "area_roots": _q("SELECT area_id, name FROM nodes WHERE parent_id IS NULL"),
    "area_parents": """
SELECT CAST(c_custkey * 10 + 1 AS VARCHAR) AS area_id, c_name AS name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT CAST(o_orderkey * 10 + 2 AS VARCHAR), 'order ' || CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    "metro_lines": """
WITH copies AS (
  SELECT o.*, 1 AS copy FROM orders o
  UNION ALL SELECT o.*, 2 FROM orders o WHERE o_orderstatus = 'F'
), txt AS (
  SELECT DISTINCT
    CASE WHEN copy = 2 AND o_orderpriority = '1-URGENT' THEN '0' || CAST(o_orderkey AS VARCHAR)
         ELSE CAST(o_orderkey AS VARCHAR) END AS line_text,
    CAST(o_custkey AS VARCHAR) AS city_text,
    'line ' || CAST(o_orderkey AS VARCHAR) AS name,
    '#' || o_orderstatus || substr(o_orderpriority, 1, 1) AS hex_color
  FROM copies
)
SELECT CAST(line_text AS BIGINT) AS metro_line_id, CAST(city_text AS BIGINT) AS city_id, name, hex_color
FROM txt""",
    "metro_stations": """
WITH copies AS (
  SELECT o.*, 1 AS copy FROM orders o
  UNION ALL SELECT o.*, 2 FROM orders o WHERE o_orderstatus = 'F'
)
SELECT l.l_partkey AS metro_station_id, c.o_orderkey AS metro_line_id,
       CAST(l.l_linenumber AS BIGINT) AS order_station, l.l_quantity AS lat, l.l_discount AS lon,
       'station ' || CAST(l.l_linenumber AS VARCHAR) AS name
FROM copies c JOIN lineitem l ON l.l_orderkey = c.o_orderkey""",
    "dictionary_keys": """
SELECT 'orders' AS name, min(c_custkey) AS first_body, CAST(0 AS BIGINT) AS first_pos,
       count(*) AS n_bodies,
       CAST((SELECT count(*) FROM orders o JOIN customer c2 ON o.o_custkey = c2.c_custkey) AS BIGINT) AS n_entries
FROM customer
UNION ALL
SELECT lower(c_mktsegment), min(c_custkey), CAST(1 AS BIGINT), count(*), CAST(count(*) AS BIGINT)
FROM customer GROUP BY lower(c_mktsegment)""",
    "dictionary_normalize": """
SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS "priority.id",
       CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS "priority.rank",
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
       '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'rush' END AS note
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "props_normalize": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "employer_ids": _q("SELECT id FROM emp_ids"),
    "employer_project": """
SELECT c.c_custkey AS employer_key,
       CASE WHEN c.c_acctbal >= 0 THEN c.c_custkey END AS id,
       CASE WHEN c.c_acctbal >= 0 THEN c.c_name END AS name,
       CASE WHEN c.c_acctbal >= 0 THEN c.c_mktsegment END AS type,
       CASE WHEN c.c_acctbal >= 0 THEN 'site/' || CAST(c.c_custkey AS VARCHAR) END AS site_url,
       CASE WHEN c.c_acctbal >= 0 THEN 'vacancies?employer_id=' || CAST(c.c_custkey AS VARCHAR) END AS vacancies_url,
       CASE WHEN c.c_acctbal >= 0 AND c.c_mktsegment <> 'AUTOMOBILE' THEN CAST(c.c_nationkey AS BIGINT) END AS area_id,
       CASE WHEN c.c_acctbal >= 0 THEN CAST(coalesce(o.n, 0) AS BIGINT) END AS open_vacancies
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey""",
    "employer_semi": _q("""
SELECT id, name, type, site_url, vacancies_url, area_id, open_vacancies
FROM emp WHERE id IN (SELECT id FROM emp_ids)"""),
    "employer_lookup": _q("""
SELECT i.id AS requested_id, e.id, e.name, e.type, e.site_url, e.vacancies_url, e.area_id, e.open_vacancies
FROM emp_ids i LEFT JOIN emp e ON i.id = e.id"""),
    "employer_batches": _q("""
SELECT CAST((row_number() OVER (ORDER BY id) - 1) // 500 AS BIGINT) AS part,
       CAST((row_number() OVER (ORDER BY id) - 1) % 500 AS BIGINT) AS pos, id
FROM emp_ids"""),
    "employer_batches_drop_last": _q("""
, kept AS (SELECT id FROM emp_ids WHERE id < (SELECT max(id) FROM emp_ids))
SELECT CAST((row_number() OVER (ORDER BY id) - 1) // 500 AS BIGINT) AS part,
       CAST((row_number() OVER (ORDER BY id) - 1) % 500 AS BIGINT) AS pos, id
FROM kept"""),
    "employer_last_part": _q("""
SELECT CAST((count(*) - 1) // 500 AS BIGINT) AS last_part, count(*) AS n_ids FROM emp_ids"""),
    "search_counts": _q("SELECT root_area, term, day, found, pages FROM counts"),
    "search_groups": """
SELECT c_custkey * 10 + 1 AS area, t.term, replace(t.term, ' ', '_') AS group_name
FROM customer, """ + TERMS_SQL,
    "search_filter": _q("""
SELECT root_area, day, id, name FROM idx
WHERE day BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND contains(lower(name), 'ring')"""),
    "request_plan": _q("""
SELECT root_area, term, day, CAST(page AS BIGINT) AS page
FROM counts, unnest(range(0, pages)) AS r(page)
WHERE found <> 0"""),
    "request_plan_reference": _q("""
SELECT root_area, term, day, CAST(page AS BIGINT) AS page
FROM counts,
     unnest(CASE WHEN pages > 1 THEN range(1, pages + 1) ELSE [0] END) AS r(page)
WHERE found <> 0"""),
    "page_assign": _q("SELECT root_area, term, day, id, page, pos FROM pg"),
    "detail_lookup": _q("SELECT root_area, term, day, page, pos, url, true AS has_detail FROM pg"),
    "area_threshold": _q("""
SELECT root_area, term, count(*) AS found,
       CASE WHEN count(*) > 1999 THEN 'split' ELSE 'whole' END AS route
FROM hits GROUP BY root_area, term"""),
    "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "csv_accumulate": _q("""
, sk AS (SELECT l_orderkey, string_agg('"' || p_name || '"', ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS js
         FROM li GROUP BY l_orderkey)
SELECT id, relations, name, area, salary_from, salary_to, type, experience, schedule, employment,
       description, '[' || coalesce(js, '') || ']' AS key_skills, archived, specializations, professional_roles,
       employer, published_at, created_at, initial_created_at, working_days, working_time_intervals,
       working_time_modes, languages, languages_level, approved
FROM good LEFT JOIN sk ON sk.l_orderkey = good.id"""),
    "incremental_ingest": _q("SELECT o_orderkey AS id, bad_reason FROM v"),
    "replace_load": _q("""
SELECT id, relations, name, area, salary_from, salary_to, type, experience, schedule, employment,
       description, key_skills, archived, specializations, professional_roles, employer, published_at,
       created_at, initial_created_at, working_days, working_time_intervals, working_time_modes,
       languages, languages_level, approved, TIMESTAMP '2024-04-23 05:05:00' AS process_dttm
FROM good"""),
    "dictionary_tables": """
SELECT 'orders' AS table_name, count(*) AS rows, CAST(8 AS BIGINT) AS columns
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT lower(c_mktsegment), count(*), CAST(5 AS BIGINT) FROM customer GROUP BY lower(c_mktsegment)""",
    "raw_tables": _q("""
SELECT 'areas' AS table_name, count(*) AS rows FROM nodes
UNION ALL
SELECT 'metro_lines', count(*) FROM (
  SELECT DISTINCT CASE WHEN c.copy = 2 AND o_orderpriority = '1-URGENT' THEN '0' ELSE '' END
                  || CAST(o_orderkey AS VARCHAR), o_custkey
  FROM (SELECT o.*, 1 AS copy FROM orders o UNION ALL
        SELECT o.*, 2 FROM orders o WHERE o_orderstatus = 'F') c)
UNION ALL
SELECT 'metro_stations', count(*) FROM lineitem l JOIN (
  SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') c
  ON l.l_orderkey = c.o_orderkey
UNION ALL
SELECT 'vacancies', count(*) FROM good
UNION ALL
SELECT 'employers', count(*) FROM emp_ids
UNION ALL
SELECT 'orders', count(*) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT lower(c_mktsegment), count(*) FROM customer GROUP BY lower(c_mktsegment)"""),
    "clean_tables": _q("""
SELECT 'areas' AS table_name, count(*) AS rows FROM (SELECT DISTINCT area_id, parent_id, name FROM nodes)
UNION ALL
SELECT 'metro_lines', count(*) FROM orders
UNION ALL
SELECT 'metro_stations', count(*) FROM (
  SELECT DISTINCT l_partkey, l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem)
UNION ALL
SELECT 'vacancies', count(*) FROM good
UNION ALL
SELECT 'employers', count(*) FROM emp WHERE id IN (SELECT id FROM emp_ids)
UNION ALL
SELECT 'employers_bad', count(*) FROM emp_ids WHERE id NOT IN (SELECT id FROM emp)
UNION ALL
SELECT v.t, 0 FROM (VALUES ('metro_lines_bad'), ('metro_stations_bad'), ('vacancies_bad')) AS v(t)
UNION ALL
SELECT 'orders', count(*) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
UNION ALL
SELECT lower(c_mktsegment), count(*) FROM customer GROUP BY lower(c_mktsegment)"""),
    "clean_vacancies": _q("""
SELECT id, name, area, employer, salary_from,
       CAST(o_orderdate AS TIMESTAMP) - INTERVAL 3 HOUR AS published_ts,
       CAST(o_orderdate AS TIMESTAMP) - INTERVAL 1 DAY - INTERVAL 3 HOUR AS initial_created_ts
FROM good"""),
    "deep_areas": """
WITH RECURSIVE n AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 100 <> 0 THEN o_orderkey - 1 END AS p,
         'order ' || CAST(o_orderkey AS VARCHAR) AS name FROM orders
), w AS (
  SELECT k, CAST(0 AS BIGINT) AS depth, k AS root, CAST(k AS VARCHAR) AS path FROM n WHERE p IS NULL
  UNION ALL
  SELECT n.k, w.depth + 1, w.root, w.path || '/' || CAST(n.k AS VARCHAR) FROM n JOIN w ON n.p = w.k
)
SELECT n.k AS area_id, n.p AS parent_id, n.name, w.depth, w.root AS root_id, w.path
FROM n LEFT JOIN w ON n.k = w.k""",
    "clean_rejects": _q("""
SELECT i.id AS requested_id, CAST(NULL AS VARCHAR) AS name, 'null_key:id' AS bad_reason
FROM emp_ids i WHERE i.id NOT IN (SELECT id FROM emp)"""),
    "clean_employers": _q("""
SELECT id, name, type, site_url, vacancies_url, area_id, open_vacancies
FROM emp WHERE id IN (SELECT id FROM emp_ids)"""),
    "clean_areas": _q("""
, d AS (SELECT DISTINCT area_id, parent_id, name, depth, root_id, ck, ok, ln FROM nodes)
SELECT CAST(area_id AS BIGINT) AS area_id, CAST(parent_id AS BIGINT) AS parent_id, name, depth,
       CAST(root_id AS BIGINT) AS root_id,
       CASE depth WHEN 0 THEN area_id
                  WHEN 1 THEN root_id || '/' || area_id
                  ELSE root_id || '/' || parent_id || '/' || area_id END AS path
FROM d"""),
    "area_split": _q(SPLIT_BASE + """
SELECT area, term, route, found, CASE WHEN route <> 'split' THEN CAST(ceil(found / 100.0) AS BIGINT) END AS pages FROM routes"""),
    "area_split_hits": _q(SPLIT_BASE + """
, place AS (SELECT c_custkey + 1000 AS area, c_nationkey + 100 AS nation, n_regionkey + 1 AS region FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT n_nationkey + 100, n_nationkey + 100, n_regionkey + 1 FROM nation
  UNION ALL SELECT r_regionkey + 1, NULL, r_regionkey + 1 FROM region)
SELECT h.id, h.term, h.area, CAST(CASE WHEN r.found <= 1999 THEN p.region WHEN n.found <= 1999 THEN p.nation ELSE h.area END AS BIGINT) AS search_area
FROM ghits h JOIN place p ON h.area = p.area JOIN gfound r ON r.area = p.region AND r.term = h.term LEFT JOIN gfound n ON n.area = p.nation AND n.term = h.term"""),
    "versioned_load": _q("""
SELECT id, area, salary_from, CASE WHEN coalesce(published_at < '1998', false) THEN 'first' ELSE 'second' END AS load FROM good"""),
    "clean_history": _q("""
, a AS (SELECT id, name, salary_from, CASE WHEN working_days IS NULL THEN salary_to END AS salary_to, schedule, experience, working_days FROM good WHERE schedule <> 'P'),
b AS (SELECT id, name, salary_from, salary_to, schedule, experience, working_days FROM good WHERE experience IS NOT NULL)
SELECT coalesce(b.id, a.id) AS id, coalesce(b.name, a.name) AS name, CASE WHEN b.id IS NULL THEN a.salary_from ELSE b.salary_from END AS salary_from,
       CASE WHEN b.id IS NULL THEN a.salary_to ELSE b.salary_to END AS salary_to, coalesce(b.schedule, a.schedule) AS schedule, coalesce(b.experience, a.experience) AS experience,
       CASE WHEN b.id IS NULL THEN a.working_days ELSE b.working_days END AS working_days,
       CASE WHEN a.id IS NULL THEN DATE '2024-04-23' ELSE DATE '2024-04-22' END AS md_ins_date,
       CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL AND a.salary_to IS NOT DISTINCT FROM b.salary_to THEN DATE '2024-04-22' ELSE DATE '2024-04-23' END AS md_upd_date,
       CASE WHEN b.id IS NULL THEN 0 ELSE 1 END AS md_is_activ, CASE WHEN b.id IS NULL THEN 1 ELSE 0 END AS md_is_delete
FROM a FULL JOIN b ON a.id = b.id"""),
    "dictionary_rows": """
WITH o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (
  SELECT 'orders' AS table_name, o_orderkey AS id, 'status' AS field, o_orderstatus AS value FROM o
  UNION ALL SELECT 'orders', o_orderkey, 'priority.id', o_orderpriority FROM o
  UNION ALL SELECT 'orders', o_orderkey, 'priority.rank', substr(o_orderpriority, 1, 1) FROM o
  UNION ALL SELECT 'orders', o_orderkey, 'price', CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS VARCHAR) END FROM o
  UNION ALL SELECT 'orders', o_orderkey, 'tags', '["' || o_orderstatus || '","' || o_orderpriority || '"]' FROM o
  UNION ALL SELECT 'orders', o_orderkey, 'note', CASE WHEN o_orderpriority = '1-URGENT' THEN 'rush' END FROM o
  UNION ALL SELECT lower(c_mktsegment), c_custkey, 'name', c_name FROM customer
  UNION ALL SELECT lower(c_mktsegment), c_custkey, 'nation.id', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT lower(c_mktsegment), c_custkey, 'nation.balance', CAST(c_acctbal AS VARCHAR) FROM customer)
SELECT table_name, id, field, value FROM r WHERE value IS NOT NULL""",
    "load_shapes": _q("""
SELECT r.run, 'vacancies' AS "table", count(*) FILTER (WHERE r.run = '2024-04-23' OR coalesce(published_at < '1998', false)) AS rows, CAST(26 AS BIGINT) AS columns,
       (SELECT count(*) FROM v WHERE bad_reason IS NOT NULL) AS rejects, TIMESTAMP '2024-04-23 05:05:00' AS loaded_at
FROM good, (VALUES ('2024-04-22'), ('2024-04-23')) AS r(run) GROUP BY r.run
UNION ALL
SELECT r.run, 'employers', count(e.id), 9, count(*) - count(e.id), TIMESTAMP '2024-04-23 05:05:00'
FROM emp_ids i LEFT JOIN emp e ON i.id = e.id, (VALUES ('2024-04-22'), ('2024-04-23')) AS r(run) GROUP BY r.run"""),
}

ORACLES |= {
    "deep_flatten": """
WITH k AS (SELECT DISTINCT o_orderkey AS k FROM orders)
SELECT CAST(k AS VARCHAR) AS area_id, CAST(lag(k) OVER w AS VARCHAR) AS parent_id, 'order ' || CAST(k AS VARCHAR) AS name,
       row_number() OVER w - 1 AS depth, CAST(first_value(k) OVER w AS VARCHAR) AS root_id
FROM k WINDOW w AS (PARTITION BY k // 100 ORDER BY k)""",
    "wide_counts": _q(WIDE_BASE + "SELECT search_area, term, year, found, pages FROM wcounts"),
    "wide_request_plan": _q(WIDE_BASE + """
SELECT search_area, term, year, CAST(page AS BIGINT) AS page FROM wcounts, unnest(range(0, pages)) AS r(page) WHERE found > 0"""),
    "wide_request_plan_reference": _q(WIDE_BASE + """
SELECT search_area, term, year, CAST(page AS BIGINT) AS page
FROM wcounts, unnest(CASE WHEN pages > 1 THEN range(1, pages + 1) ELSE [0] END) AS r(page) WHERE found > 0"""),
    "wide_page_assign": _q(WIDE_BASE + "SELECT search_area, term, year, hit AS id, page, pos FROM wpg"),
    "wide_items_reference": _q(WIDE_BASE + """
SELECT p.search_area, p.term, p.year, p.page, p.pos, p.url FROM wpg p JOIN wcounts c USING (search_area, term, year) WHERE p.page > 0 OR c.pages = 1"""),
    "wide_details": _q(WIDE_BASE + """
SELECT p.search_area, p.term, p.year, p.page, p.pos, p.url, p.has_detail, p.id, p.name, p.bad_reason,
       CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') OR NOT p.has_detail THEN NULL ELSE o_totalprice END AS salary_from
FROM wpg p JOIN orders ON o_orderkey = p.hit"""),
    "wide_page_abort": _q(WIDE_BASE + """
, bad AS (SELECT search_area, term, year, page, min(pos) AS first FROM wpg WHERE bad_reason IS NOT NULL GROUP BY search_area, term, year, page)
SELECT p.search_area, p.term, p.year, p.page, p.pos, p.id FROM wpg p LEFT JOIN bad b USING (search_area, term, year, page) WHERE b.first IS NULL OR p.pos < b.first"""),
}

ORACLES["metro_lines_sorted"] = ("SELECT *, row_number() OVER (ORDER BY city_id, metro_line_id, name, hex_color) - 1 AS row_order FROM ("
                                 + ORACLES["metro_lines"] + ")")
ORACLES["metro_stations_sorted"] = ("SELECT *, row_number() OVER (ORDER BY metro_line_id, metro_station_id, order_station, lat, lon, name) - 1 AS row_order "
                                    "FROM (" + ORACLES["metro_stations"] + ")")
ORACLES["text_id_rejects"] = """
WITH x AS (SELECT DISTINCT 'x' || CAST((l_orderkey * 10 + l_linenumber) * 10 + 3 AS VARCHAR) AS id FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 3)
SELECT 'areas' AS table_name, id, 'cast:area_id' AS bad_reason FROM x
UNION ALL SELECT 'areas', id, 'cast:parent_id' FROM x
UNION ALL SELECT 'employers', 'e' || CAST(c_custkey AS VARCHAR), 'cast:id' FROM customer WHERE c_acctbal > 5000"""
ORACLES["metro_records"] = ORACLES["metro_stations"]
ORACLES["body_audit"] = """
WITH copies AS (
  SELECT o.*, 1 AS copy FROM orders o UNION ALL SELECT o.*, 2 FROM orders o WHERE o_orderstatus = 'F'
), l AS (
  SELECT c_custkey, c_name, c_acctbal, o_orderkey, o_orderstatus, o_orderpriority,
         '$.lines[' || CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey, copy) - 1 AS VARCHAR) || ']' AS path,
         CASE WHEN o_orderstatus = 'P' THEN 'L' WHEN copy = 2 AND o_orderpriority = '1-URGENT' THEN '0' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS id,
         o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AS no_stations,
         CASE WHEN copy = 2 AND o_orderpriority = '1-URGENT' THEN '0' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS text
  FROM copies JOIN customer ON o_custkey = c_custkey WHERE c_acctbal <= 9000
), s AS (
  SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount) - 1 AS j FROM lineitem
), found AS (
  SELECT c_name, c_acctbal, '$.lines' AS path, 'missing:lines' AS rule, CAST(NULL AS VARCHAR) AS value FROM customer WHERE c_acctbal > 9000
  UNION ALL SELECT c_name, c_acctbal, '$.id', 'cast:city_id', 'c' || CAST(c_custkey AS VARCHAR) FROM customer
    WHERE c_acctbal BETWEEN -500 AND 0 AND c_custkey IN (SELECT o_custkey FROM orders)
  UNION ALL SELECT c_name, c_acctbal, path || '.id', 'cast:metro_line_id', id FROM l WHERE o_orderstatus = 'P'
  UNION ALL SELECT c_name, c_acctbal, path || '.stations', 'missing:stations', NULL FROM l WHERE no_stations
  UNION ALL SELECT c_name, c_acctbal, path || '.stations[' || CAST(j AS VARCHAR) || '].id', 'part:metro_station_id', text FROM l JOIN s ON l_orderkey = o_orderkey
    WHERE l_quantity = 50 AND NOT no_stations
)
SELECT 'lines' AS layout, c_name AS city, path, rule, value FROM found WHERE c_acctbal >= -900
UNION ALL SELECT 'lines', c_name, '$', 'json', NULL FROM customer WHERE c_acctbal < -900
UNION ALL SELECT 'array', c_name, path, rule, value FROM found"""
ORACLES["employer_parts"] = _q("""
, b AS (SELECT id, CAST((row_number() OVER (ORDER BY id) - 1) // 500 AS BIGINT) AS part FROM emp_ids),
z AS (SELECT max(part) AS last, CAST(ceil((max(part) + 1) / 4.0) AS BIGINT) AS step FROM b)
SELECT b.id AS requested_id, e.id, e.name, e.type, e.site_url, e.vacancies_url, e.area_id, e.open_vacancies, b.part,
       b.part // z.step = z.last // z.step AS asked_again
FROM b, z LEFT JOIN emp e ON b.id = e.id""")
