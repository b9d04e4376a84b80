"""Arbitrary-depth tree flattening (G1, P11, F5) and area selections.

The tree is walked a few levels per pass: a pass parses ``LEVELS_PER_PASS``
levels with a schema nested that deep, keeping the deepest child lists as raw
JSON text, and emits every node of those levels with one ``inline`` over an
array built by ``transform``/``flatten`` (no recursive schema, no driver
recursion).  Every node carries ``depth``, ``root_id`` and a ``path`` of child
positions, so depth-first pre-order is simply ``ORDER BY path``.  After each
pass the rows are re-spread across partitions, so one oversized subtree does
not keep all its descendants in the task that parsed it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobnest.operators.indexing import with_row_index
from jobnest.session import checkpoint_root

NODE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("areas", T.StringType()),   # child list kept as JSON text
])
NODE_LIST = T.ArrayType(NODE)

LEVELS_PER_PASS = 4

_ROW = T.StructType([
    T.StructField("area_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("rel", T.ArrayType(T.IntegerType())),   # child positions below the pass's start
    T.StructField("kids", T.StringType()),                # unparsed child list of the deepest level
    T.StructField("rid", T.StringType()),                 # root id
])
_ROWS = T.ArrayType(_ROW)


def node_type(levels: int) -> T.StructType:
    """A node parsed ``levels`` deep; the deepest child list stays JSON text."""
    t = NODE
    for _ in range(levels - 1):
        t = T.StructType([*NODE.fields[:3], T.StructField("areas", T.ArrayType(t))])
    return t


def _rows(arr: Column, levels: int, prefix: Column, root: Column | None) -> Column:
    """Every node of ``arr`` and of its next ``levels - 1`` levels, as one array of rows."""
    def own(n, i):
        return F.struct(
            n["id"].alias("area_id"),
            n["parent_id"].alias("parent_id"),            # the node's own field wins over nesting
            n["name"].alias("name"),
            F.concat(prefix, F.array(i)).alias("rel"),
            (n["areas"] if levels == 1 else F.lit(None).cast("string")).alias("kids"),
            (root if root is not None else n["id"]).alias("rid"))

    rows = F.transform(arr, own)
    if levels > 1:
        deeper = F.flatten(F.transform(arr, lambda n, i: F.coalesce(
            _rows(n["areas"], levels - 1, F.concat(prefix, F.array(i)),
                  root if root is not None else n["id"]),
            F.array().cast(_ROWS))))
        rows = F.concat(rows, deeper)
    return rows


def _below(levels: int) -> T.StructType:
    """A node with nothing but its child lists, parsed ``levels`` deep; the deepest one stays JSON text."""
    t = T.StructType([NODE["areas"]])
    for _ in range(levels - 1):
        t = T.StructType([T.StructField("areas", T.ArrayType(t))])
    return t


def _goes_deeper(nodes: Column, levels: int) -> Column:
    """Whether a node of the deepest of ``levels`` levels below ``nodes`` has children."""
    return F.exists(nodes, lambda n: _has_children(n["areas"]) if levels == 1 else _goes_deeper(n["areas"], levels - 1))


def _has_children(text: Column) -> Column:
    """recurse only into a non-empty child list."""
    # a JSON list is empty if its bracket closes right behind the white space
    return F.coalesce(~F.ltrim(F.substring(F.ltrim(text), 2, 1 << 30)).startswith("]"), F.lit(False))


def area_flatten_records(records: DataFrame, root_order_col: str | None = "root_order", **kw) -> DataFrame:
    """G1 over roots already read as records (columns id, parent_id, name, areas-as-text)."""
    order = F.col(root_order_col) if root_order_col else F.lit(0)
    arr = F.array(F.struct(*[F.col(f.name) for f in NODE.fields]))
    first = records.select(order.cast("bigint").alias("root_order"),
                           F.inline(_rows(arr, 1, F.array().cast("array<int>"), None)))
    return _walk(_first_level(first, wrapped=True), **kw)


def area_flatten(bodies: DataFrame, body_col: str = "body", root_order_col: str | None = None,
                 body_is_array: bool = False,
                 checkpoint_every: int = 8) -> DataFrame:
    """G1: tree bodies -> one row per node (area_id, parent_id, name, depth, path, root_id, root_order).

    ``bodies`` holds one tree per row (``body_is_array=False``) or the raw API
    response, a JSON array of roots.  ``root_order_col`` orders roots for the
    pre-order (defaults to the root's position inside its body).
    """
    order = F.col(root_order_col) if root_order_col else F.lit(0)
    k = LEVELS_PER_PASS
    parsed = lambda t: F.from_json(F.col(body_col), T.ArrayType(t)) if body_is_array else F.array(F.from_json(F.col(body_col), t))
    arr = parsed(node_type(k))
    # the bodies are asked with the child lists alone; no node is made for that
    deeper = bodies.where(_goes_deeper(parsed(_below(k)), k))
    # a NULL body (or NULL root element) gives no node; positions of the others are kept
    first = bodies.select(order.alias("root_order"),
                          F.inline(F.filter(_rows(arr, k, F.array().cast("array<int>"), None),
                                            lambda r: r["rid"].isNotNull() | r["area_id"].isNotNull()
                                            | r["name"].isNotNull())))
    return _walk(_first_level(first, wrapped=not body_is_array), deeper, checkpoint_every=checkpoint_every)


def _first_level(rows: DataFrame, wrapped: bool) -> DataFrame:
    rel = F.col("rel")
    path = F.slice(rel, 2, F.size(rel) - 1) if wrapped else rel   # a lone root has path []
    return rows.select(F.col("area_id"), F.col("parent_id"), F.col("name"),
                       (F.size(rel) - 1).alias("depth"), path.alias("path"),
                       F.col("rid").alias("root_id"), "root_order", F.col("kids").alias("_children"))


def _walk(first: DataFrame, deeper: DataFrame | None = None, checkpoint_every: int = 8) -> DataFrame:
    """Continue below the deepest parsed level, LEVELS_PER_PASS levels per pass, until no node has children.

    A forest that the first pass holds whole comes back lazily, so later filters and column choices reach the scan.
    ``deeper`` has no rows in that case (default: the first pass's nodes with unparsed children).
    """
    spark = first.sparkSession
    checkpoint_root(spark)  # lineage cuts go to the shared checkpoint folder
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    k = LEVELS_PER_PASS
    if (first.where(_has_children(F.col("_children"))) if deeper is None else deeper).isEmpty():
        return first.drop("_children")
    level = first.persist(StorageLevel.MEMORY_AND_DISK)
    keep: list[DataFrame] = [level]
    passes = 0
    while True:
        nxt = level.where(_has_children(F.col("_children"))).select(
            "root_order", "path", "depth", "root_id",
            F.inline(_rows(F.from_json("_children", T.ArrayType(node_type(k))), k,
                           F.array().cast("array<int>"), F.col("root_id"))))
        nxt = nxt.select("area_id", "parent_id", "name",
                         (F.col("depth") + F.size("rel")).alias("depth"),
                         F.concat(F.col("path"), F.col("rel")).alias("path"),
                         "root_id", "root_order", F.col("kids").alias("_children"))
        # re-spread: one oversized subtree does not stay in the task that parsed it
        nxt = nxt.repartition(n_parts, "root_id", "path")
        passes += 1
        if passes % checkpoint_every == 0:
            nxt = nxt.checkpoint(eager=True)
        nxt = nxt.persist(StorageLevel.MEMORY_AND_DISK)   # computed once: probe, then reuse
        if nxt.isEmpty():
            nxt.unpersist()
            break
        keep.append(nxt)
        level = nxt
    out = keep[0].drop("_children")
    for lv in keep[1:]:
        out = out.unionByName(lv.drop("_children"))
    # materialise the result in the shared checkpoint folder, then release the
    # per-pass caches (a long-lived session would otherwise keep them all)
    out = out.checkpoint(eager=True)
    for lv in keep:
        lv.unpersist()
    return out


def area_preorder(flat: DataFrame, index_col: str = "preorder") -> DataFrame:
    """Depth-first pre-order position of every node inside its root's tree (0 = the root)."""
    return with_row_index(flat, order_cols=["path"], group_cols=["root_order", "root_id"],
                          index_col=index_col)


def area_roots(flat: DataFrame) -> DataFrame:
    """top-level areas (no parent) -- the areas a search runs under."""
    return flat.where(F.col("parent_id").isNull()).select("area_id", "name")


def area_parents(flat: DataFrame) -> DataFrame:
    """areas that are the parent of at least one other area."""
    parents = flat.where(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("area_id")).distinct()
    return flat.select("area_id", "name").join(parents, "area_id", "left_semi")


def node_rows(flat: DataFrame) -> DataFrame:
    """The raw ``areas`` table columns."""
    return flat.select("area_id", "parent_id", "name")
