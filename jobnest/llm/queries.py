"""The registered queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobnest.session import work_root

from . import html_text, jaccard_join, langid, maxscore, merkle, minhash, mixture, order_minhash, part_codes, passages, secrets, sp_dropout, token_store
from .common import table

#: Vocabulary files of the public tokenizers, by name in the installed package.
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixture.mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op5_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % maxscore.QUERY_STEP == 0)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_root(spark, "llm", "tokens", unique=True)
    token_store.write(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), path)
    return token_store.read(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = langid.train(docs, ~langid.held_out(F.col("doc_id")))
    return langid.predict(docs, profiles).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents"))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare(table(spark, sf_dir, "documents"))


def op10_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_dropout.round_trip(table(spark, sf_dir, "documents"), vocabulary(PIECE_BPE))


def op11_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def op12_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_codes.digests(*part_codes.compress(table(spark, sf_dir, "embeddings")))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_html_text, op3_source_mix, op4_near_duplicates, op5_maxscore_top_k, op6_token_files, op7_language_id, op8_repeated_passages, op9_order_minhash, op10_merge_dropout, op11_merkle_proofs, op12_part_codes, op13_jaccard_join)}

def _part_codes_sql() -> str:
    """The four rounds one after another, then the last assignment."""
    sql = """
WITH v AS MATERIALIZED (
    SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (
    SELECT vec_id, label, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS x FROM v, range(4) t(part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p QUALIFY entry < 256)"""
    for i in range(part_codes.ROUNDS + 1):
        sql += f""",
a{i} AS MATERIALIZED (
    SELECT vec_id, label, part, x, min(dist) AS dist, arg_min(entry, (dist, entry)) AS entry
    FROM (SELECT p.*, b.entry, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.x, b.x)]) AS BIGINT) AS dist FROM p JOIN b{i} b USING (part)) GROUP BY vec_id, label, part, x)"""
        if i < part_codes.ROUNDS:
            sql += f""",
m{i} AS (
    SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY k) AS x
    FROM (SELECT part, entry, k, CAST(sum(c) AS BIGINT) AS s, count(*) AS n FROM (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS k FROM a{i}) GROUP BY part, entry, k) GROUP BY part, entry),
b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (part, entry))"""
    last = part_codes.ROUNDS
    return sql + f""",
codes AS (
    SELECT vec_id, label, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{last} GROUP BY vec_id, label),
labels AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM codes GROUP BY label),
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM b{last})
SELECT vec_id, code, error, label_error, h AS codebooks_sha256 FROM codes JOIN labels ON codes.label IS NOT DISTINCT FROM labels.label, book"""


ORACLES = {
    "op4_near_duplicates": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_sort(list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) END AS s FROM w),
items AS (SELECT doc_id, unnest(s) AS item FROM sets),
copies AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
rep_items AS (SELECT rep, n, unnest(s) AS item FROM copies),
pairs AS (
    SELECT a.rep AS a, b.rep AS b FROM rep_items a JOIN rep_items b ON a.item = b.item AND a.rep < b.rep AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(a, b) AS (SELECT rep, rep FROM copies UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
roots AS (SELECT a AS rep, min(b) AS root FROM reach GROUP BY a),
by_set AS (SELECT c.s, r.root FROM copies c JOIN roots r USING (rep))
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(x.root, d.doc_id) AS component_id, coalesce(x.root, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN by_set x ON d.s = x.s""",
    "op5_maxscore_top_k": """
WITH v AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op11_merkle_proofs": r"""
WITH RECURSIVE crc_steps(i, step, c) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_steps WHERE step = 8),
d AS (
    SELECT *, coalesce(xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
        lambda acc, x: xor(acc >> 8, crc_table.t[(xor(acc, x) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 5 = 0, false) AS hit
    FROM documents, crc_table),
heads AS (
    SELECT doc_id, source, text, hit,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
        || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM d),
leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN hit THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered FROM heads),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
lv(source, level, idx, n, digest) AS (
    SELECT source, 0, idx, n, leaf FROM numbered
    UNION ALL SELECT source, level + 1, idx // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY idx)) FROM lv WHERE n > 1 GROUP BY source, level, idx // 16),
subs AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM lv WHERE n = 1),
up(level, idx, n, digest) AS (
    SELECT 0, idx, n, digest FROM subs
    UNION ALL SELECT level + 1, idx // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY level, idx // 16),
nodes AS (
    SELECT source, false AS top, level, idx, n, digest FROM lv UNION ALL SELECT NULL, true, level, idx, n, digest FROM up),
sides AS (
    SELECT source, top, level, idx, n,
        coalesce(string_agg(digest, '') OVER (PARTITION BY source, top, level, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(digest, '') OVER (PARTITION BY source, top, level, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM nodes),
climb(doc_id, leaf, source, idx0, level, idx, n, cur, proof) AS (
    SELECT doc_id, leaf, source, idx, 0, idx, n, coalesce(tampered, leaf), '' FROM numbered
    UNION ALL SELECT c.doc_id, c.leaf, c.source, c.idx0, c.level + 1, c.idx // 16, (c.n + 15) // 16, sha256(s.before || c.cur || s.after), c.proof || s.before || s.after
    FROM climb c JOIN sides s ON NOT s.top AND s.source IS NOT DISTINCT FROM c.source AND s.level = c.level AND s.idx = c.idx WHERE c.n > 1),
climb_top(doc_id, leaf, source, idx0, level, idx, n, subroot, cur, proof) AS (
    SELECT c.doc_id, c.leaf, c.source, c.idx0, 0, s.idx, s.n, s.digest, c.cur, c.proof FROM climb c JOIN subs s ON s.source IS NOT DISTINCT FROM c.source WHERE c.n = 1
    UNION ALL SELECT c.doc_id, c.leaf, c.source, c.idx0, c.level + 1, c.idx // 16, (c.n + 15) // 16, c.subroot, sha256(s.before || c.cur || s.after), c.proof || s.before || s.after
    FROM climb_top c JOIN sides s ON s.top AND s.level = c.level AND s.idx = c.idx WHERE c.n > 1)
SELECT doc_id, leaf, subroot, (SELECT digest FROM up WHERE n = 1) AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = (SELECT digest FROM up WHERE n = 1) AS verified
FROM climb_top WHERE n = 1""",
    "op12_part_codes": _part_codes_sql(),
    "op13_jaccard_join": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)])) END AS s FROM w),
copies AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
rep_items AS (SELECT rep, n, unnest(s) AS item FROM copies),
pairs AS (
    SELECT a.rep AS a, b.rep AS b FROM rep_items a JOIN rep_items b ON a.item = b.item AND a.rep < b.rep AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(a, b) AS (SELECT rep, rep FROM copies UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
roots AS (SELECT a AS rep, min(b) AS root FROM reach GROUP BY a),
by_set AS (SELECT c.s, r.root FROM copies c JOIN roots r USING (rep))
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(x.root, d.doc_id) AS component_id
FROM sets d LEFT JOIN by_set x ON d.s = x.s""",
}
