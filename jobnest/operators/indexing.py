"""Exact, contiguous, skew-safe row numbering (used by B1 batches, L1 pages, G1 pre-order).

``row_number()`` over an un-partitioned window (or over a hot group) funnels
every row through one task.  Here instead:

1. range-partition on (group, order) keys and sort inside each partition ->
   a hot group is cut across many partitions by the sampled range bounds, and
   inside a partition each group's rows are contiguous and in order;
2. tag rows with their partition and ``monotonically_increasing_id`` (which
   counts rows in partition order), and checkpoint, so the tags are fixed;
3. per (range partition, group): row count and smallest tag -> at most
   #partitions rows per group;
4. running sum of those counts per group -> each range's starting offset;
5. index = offset + (tag - smallest tag): plain arithmetic, no window over data.

The only windows run over the count table.  The checkpoint (in the shared
folder) pins partition ids and tags for every later read, also after a lost
executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from jobnest.session import checkpoint_root


def with_row_index(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
                   index_col: str = "row_index", num_ranges: int | None = None) -> DataFrame:
    """Add a 0-based contiguous index following ``order_cols`` within each group.

    ``order_cols`` should make the order total (ties are numbered arbitrarily,
    as with ``row_number``).
    """
    group_cols = list(group_cols or [])
    spark = df.sparkSession
    n = num_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    checkpoint_root(spark)
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_rp", F.spark_partition_id())
              .withColumn("_tag", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = ranged.groupBy("_rp", *group_cols).agg(F.count(F.lit(1)).alias("_n"),
                                                    F.min("_tag").alias("_first"))
    before = Window.partitionBy(*group_cols).orderBy("_rp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_rp").alias("_orp"),
        *[F.col(c).alias(f"_og_{c}") for c in group_cols],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"), "_first")
    cond = ranged["_rp"] == offsets["_orp"]
    for c in group_cols:
        cond = cond & ranged[c].eqNullSafe(offsets[f"_og_{c}"])
    if not group_cols:
        offsets = F.broadcast(offsets)   # one row per range: at most ``n`` rows
    return (ranged.join(offsets, cond, "inner")
            .withColumn(index_col, F.col("_off") + F.col("_tag") - F.col("_first"))
            .drop("_rp", "_orp", "_off", "_tag", "_first", *[f"_og_{c}" for c in group_cols]))
