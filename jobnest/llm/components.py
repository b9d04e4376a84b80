"""Connected components of an edge table by repeated contraction, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of ``edges`` (a, b): nodes have the same root exactly if they are connected.

    Each round every node takes the neighbour with the smallest keyed hash (itself included) as its parent and the
    edges are contracted to parents.  Hashes, not ids, rank the nodes: along a sorted chain only about a third of the
    nodes survive a round.  A node's edges are pre-aggregated before the shuffle, so a hub is no hot key."""
    label = None
    turn = 0
    edges = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("id"))  # noqa: B023,E731
        parent = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min(rank("b")), F.first(rank("a")))["id"].alias("root"))
        parent = written(parent, "parents")
        if label is None:
            label = parent
        else:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("up"))
            label = written(label.join(up, "root", "left").select("id", F.coalesce("up", "root").alias("root")), "labels")
        of = lambda c: parent.select(F.col("id").alias(c), F.col("root").alias(f"_{c}"))  # noqa: B023,E731
        edges = written(edges.join(of("a"), "a").join(of("b"), "b").filter("_a <> _b")
                        .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
        turn += 1
        if edges.isEmpty():
            return label
