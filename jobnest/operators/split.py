"""searches refined over the area tree until each one's hits fit the limit of a search.

A search over an area returns its hits and those of all areas below it.  Hits are counted where they sit, rolled up the
tree (every count is added to all areas on its path, one shuffle whatever the depth), and the tree is cut top-down: an
area is searched whole as soon as its hits fit; one with too many is split into the areas below it, and what sits at a
split area itself gets a search of its own.  An area is reached exactly if its parent was split, so one join of the counts
with themselves decides every area; hits are joined once, by the area they sit at.

Routes: ``split`` (too many hits, searched below), ``whole`` (searched with all below), ``own`` (what sits at a split area
itself), ``over`` (too many hits at one place: no area below can part them).  Areas that the tree does not know, or that
hang on a cycle or a missing parent, count as roots, so no hit is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobnest.operators.requests import PER_PAGE, SPLIT_THRESHOLD


def _on_path(hits: DataFrame, areas: DataFrame) -> DataFrame:
    """(area, term, own, above, parent) for every area with hits and every area on its path, itself included."""
    own = hits.groupBy("area", "term").agg(F.count(F.lit(1)).alias("own"))
    paths = areas.select(F.col("area_id").alias("area"), "path_ids")
    joined = own.join(paths, "area", "left").withColumn("path_ids", F.coalesce("path_ids", F.array("area")))
    each = joined.select("area", "term", "own", "path_ids", F.posexplode("path_ids").alias("pos", "above"))
    return each.select("area", "term", "own", "above", F.when(F.col("pos") > 0, F.get("path_ids", F.col("pos") - 1)).alias("parent"))


def split_searches(hits: DataFrame, areas: DataFrame, limit: int = SPLIT_THRESHOLD,
                   per_page: int = PER_PAGE) -> DataFrame:
    """(area, term, route, found, pages) of every reached area; ``pages`` is NULL for split ones, which are not searched.

    ``hits``: (area, term, ...), one row per hit; ``areas``: (area_id, path_ids), ids from the root down to the area."""
    found = (_on_path(hits, areas).groupBy(F.col("above").alias("area"), "term")
             .agg(F.sum("own").alias("found"), F.max("parent").alias("parent"),
                  F.coalesce(F.sum(F.when(F.col("area") == F.col("above"), F.col("own"))), F.lit(0)).alias("own")))
    upper = found.select(F.col("area").alias("parent"), "term", F.col("found").alias("parent_found"))
    reached = found.join(upper, ["parent", "term"], "left").where(F.col("parent").isNull() | (F.col("parent_found") > limit))
    fits, below = F.col("found") <= limit, F.col("found") > F.col("own")
    rows = F.filter(F.array(
        F.struct(F.when(fits, F.lit("whole")).when(below, F.lit("split")).otherwise(F.lit("over")).alias("route"), F.col("found").alias("found")),
        F.when(~fits & below & (F.col("own") > 0), F.struct(F.when(F.col("own") <= limit, F.lit("own")).otherwise(F.lit("over")).alias("route"), F.col("own").alias("found")))),
        lambda r: r.isNotNull())
    out = reached.select("area", "term", F.inline(rows))
    pages = F.when(F.col("route") != "split", F.ceil(F.col("found") / per_page).cast("bigint"))
    return out.withColumn("pages", pages)


def split_hits(hits: DataFrame, areas: DataFrame, searches: DataFrame) -> DataFrame:
    """Every hit with the one search (``search_area``) that returns it."""
    # whole trees first; a place under split areas only has its own search
    done = searches.where("route = 'whole'").select(F.col("area").alias("above"), "term")
    covered = _on_path(hits, areas).join(done, ["above", "term"], "left_semi").select("area", "term", F.col("above").alias("search_area"))
    return hits.join(covered, ["area", "term"], "left").withColumn("search_area", F.coalesce("search_area", "area"))
