"""A Merkle manifest of a table, with a proof for every row, by pointer jumping.

Every row is a leaf.  The leaves of a source, in the order of their ids, are hashed in runs of ``FAN`` until one node
remains, the *subroot*; the subroots, in the order of their sources, are hashed likewise to the one *root*.  A run knows
its members; a member's siblings are the others of its run, some before it and some behind it.

Proofs come from pointer jumping: every inner node starts with a pointer to its parent and a path of one segment, its
siblings there.  A self-join gives each node the pointer and the path of the node it points to, which are appended to its
own, so the distance doubles from round to round, and a tree of any depth needs as many rounds as its depth has binary
digits.  Leaves join their run's path last and are unfolded from the run, so their segments are never shuffled.  A node
that very many others point to is copied to as many parts as keep a part small.

Rows without an id come first in their source, rows that repeat an id stand in the order of their leaves; equal rows are
leaves of their own.  A null source is a source and comes before all others.  Texts of any length are hashed whole, within
one row.  Other columns take no part, whatever their names.  An empty table gives no rows and no root.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, written
from .ordering import running

FAN = 16
FIELDS = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
#: Rows that one copy of a node serves in a self-join.
SERVED = 4096

MEMBER = "pos long, digest string, id string, payload struct<doc_id: long, tampered: string>"
PATH = "array<struct<before: string, own: string, after: string>>"


class Manifest(NamedTuple):
    #: (id, tree, idx, n, total, digest, members, upper) of every run; ``upper`` marks the runs over subroots.
    runs: DataFrame
    #: (id, path) of every inner node but the root, from its own segment to the root's run.
    paths: DataFrame
    #: None for an empty table.
    root: str | None
    #: The one row of a table of one row, which is no member of any run.
    lone: DataFrame | None


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """Lowercase hex sha256 of the fields: ``-`` or byte count, colon and value."""
    return F.sha2(F.concat(*map(field, values)), 256)


def lowered(text: Column) -> Column:
    """A-Z alone lower-cased."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, tampered) of every row: the leaf, and what it becomes if the text is tampered with (null
    where this row is left alone)."""
    rows = pick(docs, **FIELDS)
    own = [F.col(n) for n in FIELDS]
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return rows.select("source", "doc_id", leaf(*own).alias("leaf"), F.when(hit, leaf(*own[:4], lowered(F.col("text")))).alias("tampered"))


def _levels(most: int) -> int:
    """Levels above the leaves of a tree whose nodes number ``most``."""
    n = 0
    while most > 1:
        most, n = -(-most // FAN), n + 1
    return n


def _grow(rows: DataFrame, levels: int, prefix: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs, level by level, and the node that remains of each tree: rows are (tree, idx, n, total, digest, id, payload),
    n the tree's nodes on this level, total those on the lowest."""
    runs, tops = [], [rows.filter("n = 1")]
    members = F.sort_array(F.collect_list(F.struct(F.pmod("idx", F.lit(FAN)).alias("pos"), "digest", "id", "payload"))).alias("members")
    for level in range(1, levels + 1):
        run = rows.filter("n > 1").groupBy("tree", F.floor(F.col("idx") / FAN).cast("long").alias("idx"), F.ceil(F.col("n") / FAN).cast("long").alias("n"), "total").agg(members)
        run = run.withColumn("id", F.concat(F.lit(f"{prefix}:{level}:"), "idx", F.coalesce(F.concat(F.lit(":"), "tree"), F.lit(""))))
        run = written(run.withColumn("digest", F.sha2(F.array_join(F.transform("members", lambda m: m["digest"]), ""), 256)), "runs")
        runs.append(run)
        rows = run.select("tree", "idx", "n", "total", "digest", "id", F.lit(None).cast("struct<doc_id: long, tampered: string>").alias("payload"))
        tops.append(rows.filter("n = 1"))
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return runs, top


def _segments(runs: DataFrame) -> DataFrame:
    """(up, member, segment) of every member of every run."""
    m = F.col("member")
    join = lambda keep: F.array_join(F.transform(F.filter("members", keep), lambda x: x["digest"]), "")
    each = runs.select(F.col("id").alias("up"), "members", F.explode("members").alias("member"))
    return each.select("up", "member", F.struct(join(lambda x: x["pos"] < m["pos"]).alias("before"), m["digest"].alias("own"), join(lambda x: x["pos"] > m["pos"]).alias("after")).alias("segment"))


def manifest(docs: DataFrame) -> Manifest:
    """The tree over all rows of ``docs`` and the paths of its inner nodes."""
    rows = written(leaves(docs).withColumn("one", F.lit(1)), "leaves")
    numbered = written(running(rows, ["source"], ["doc_id", "leaf"], "one", "idx", "dealt").select(
        F.col("source").alias("tree"), "idx", F.col("idx_total").alias("n"), F.col("idx_total").alias("total"), F.col("leaf").alias("digest"),
        F.lit(None).cast("string").alias("id"), F.struct("doc_id", "tampered").alias("payload")), "numbered")
    largest = numbered.agg(F.max("n")).first()[0]
    if largest is None:
        return Manifest(rows, rows, None, None)
    runs, tops = _grow(numbered, _levels(largest), "s")
    # the sources' trees end in subroots, which are the leaves of the last tree
    sub = written(tops.withColumn("one", F.lit(1)), "subroots")
    sub = running(sub.select(F.col("tree").alias("source"), "digest", "id", "payload", "one"), [], ["source"], "one", "idx", "sources")
    sub = written(sub.select(F.lit(None).cast("string").alias("tree"), "idx", F.col("idx_total").alias("n"), F.col("idx_total").alias("total"), "digest", "id", "payload"), "numbered")
    sources = sub.agg(F.max("n")).first()[0]
    upper, root = _grow(sub, _levels(sources), "t")
    last = root.first()
    everything = [*[r.withColumn("upper", F.lit(False)) for r in runs], *[r.withColumn("upper", F.lit(True)) for r in upper]]
    if not everything:
        return Manifest(rows, rows, last["digest"], root)
    all_runs = everything[0]
    for r in everything[1:]:
        all_runs = all_runs.unionByName(r)
    return Manifest(all_runs, _jump(all_runs, _levels(largest) + _levels(sources)), last["digest"], None)


def _jump(runs: DataFrame, depth: int) -> DataFrame:
    """(id, path) of every inner node that is a member of a run: self-joins double the distance to ``up``."""
    inner = _segments(runs).filter("member.id is not null").select(F.col("member.id").alias("id"), "up", F.array("segment").alias("path"))
    nodes = written(inner, "nodes")
    distance = 1
    while distance < depth:
        # a node serves up to FAN ** distance others of a level
        copies = max(1, -(-min(FAN**distance, nodes.count()) // SERVED))
        wanted = nodes.groupBy(F.col("up").alias("id")).agg(F.count("*").alias("served")).select("id")
        above = nodes.join(wanted, "id").select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("path").alias("more"), F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
        mine = nodes.withColumn("copy", F.pmod(F.xxhash64("id"), F.lit(copies)).cast("int"))
        # at the root's run there is nothing to join
        nodes = written(mine.join(above, ["up", "copy"], "left").select("id", F.coalesce("next", "up").alias("up"), F.concat("path", F.coalesce("more", F.array().cast(PATH))).alias("path")), "nodes")
        distance *= 2
    return nodes.select("id", "path")


def proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, tampered, proof, subroot, root) of every row: ``proof`` lists, from the leaf's run to the root's,
    the digests before and behind the node, joined."""
    made = manifest(docs)
    if made.root is None:
        return docs.sparkSession.createDataFrame([], f"doc_id long, leaf string, tampered string, proof {PATH}, subroot string, root string")
    if made.lone is not None:
        return made.lone.select("payload.doc_id", F.col("digest").alias("leaf"), "payload.tampered", F.array().cast(PATH).alias("proof"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    runs = made.runs.filter(F.exists("members", lambda m: m["payload"].isNotNull()))
    joined = runs.join(made.paths, "id", "left").select("id", "members", "path", "upper", "total")
    levels = F.lit(1)
    for i in range(1, 15):  # 16 ** 15 rows are more than a long can number
        levels = levels + (F.col("total") > F.lit(FAN**i)).cast("int")
    m = F.col("member")
    join = lambda keep: F.array_join(F.transform(F.filter("members", keep), lambda x: x["digest"]), "")
    each = joined.select("members", F.coalesce("path", F.array().cast(PATH)).alias("path"), "upper", levels.alias("levels"), F.explode("members").alias("member")).filter("member.payload is not null")
    own = F.struct(join(lambda x: x["pos"] < m["pos"]).alias("before"), m["digest"].alias("own"), join(lambda x: x["pos"] > m["pos"]).alias("after"))
    each = each.select(m["payload"]["doc_id"].alias("doc_id"), m["digest"].alias("leaf"), m["payload"]["tampered"].alias("tampered"), F.concat(F.array(own), F.col("path")).alias("proof"), "upper", "levels")
    # the segment of a source's subroot, in the last tree, names it; with one source the subroot is the root
    sub = F.when(F.col("upper"), F.col("leaf")).otherwise(F.get("proof", F.col("levels"))["own"])
    return each.select("doc_id", "leaf", "tampered", "proof", F.coalesce(sub, F.lit(made.root)).alias("subroot"), F.lit(made.root).alias("root"))


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, start, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def verified(docs: DataFrame) -> DataFrame:
    """Every row with its proof's digest and the root that its leaf, tampered with or not, folds to."""
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["after"])), "")
    out = proofs(docs).select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
