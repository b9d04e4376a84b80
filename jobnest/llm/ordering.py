"""Running totals and neighbours along a global order, without one task that holds everything.

Rows are dealt out by key range and written once; totals of the ranges (one row per range and group) give the offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written


def running(df: DataFrame, group: list[str], order: list[str], value: str, out: str, what: str) -> DataFrame:
    """``df`` with the long ``out``: the sum of ``value`` over the rows of the same group that come before, and the
    group's ``{out}_total``.  A group of any size spreads over ranges; ties in ``order`` come in some fixed order.
    Besides, ``_row`` numbers the rows uniquely (not densely)."""
    dealt = written(df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), what)
    parts = dealt.groupBy(*group, "_range").agg(F.sum(value).alias("_sum"))
    by_group = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    parts = parts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_range").alias("_part"),
                         (F.sum("_sum").over(by_group.orderBy("_range")) - F.col("_sum")).alias("_before"),
                         F.sum("_sum").over(by_group).alias(f"{out}_total"))
    same = F.col("_range") == F.col("_part")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    in_range = W.partitionBy("_range", *group).orderBy(*order, "_row").rowsBetween(W.unboundedPreceding, -1)
    inside = dealt.withColumn("_inside", F.coalesce(F.sum(value).over(in_range), F.lit(0)))
    return (inside.join(parts, same)
            .withColumn(out, (F.col("_before") + F.col("_inside")).cast("long"))
            .drop("_part", "_before", "_inside", "_range", *[f"_g{i}" for i in range(len(group))]))
