"""The ``;``-delimited staging text, read with an explicit schema.

Dialect: ``;`` separator, header line, ``"`` quotes doubled inside values
(``escape='"'``), values may span lines, records end with a line feed.

Spark's own reader can't split a file whose values span lines.  With a schema,
``read_records`` therefore finds the records itself: the file is read as lines,
in as many splits as its size gives, and whether a line begins inside quotes
follows from the parity of the quotes before it.  That takes one count per
split and a running sum over the splits.  A record whose lines lie in several
splits is put together from the one fragment that each of them holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

CSV_OPTIONS = {"sep": ";", "header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
_AT = ["_file", "_split"]


def read_staging(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                 fmt: str = "csv") -> DataFrame:
    if fmt == "parquet":
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if schema is None:
        return spark.read.options(**CSV_OPTIONS).option("inferSchema", "true").csv(path)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    records = read_records(spark, path)
    # a folder's partition column keeps its declared type
    folders = [f for f in schema.fields if f.name in records.columns and f.name != "record"]
    cells = T.StructType([f for f in schema.fields if f not in folders])
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    parsed = records.withColumn("record", F.from_csv("record", cells.toDDL(), options))
    typed = {f.name: F.col(f.name).cast(f.dataType).alias(f.name) for f in folders}
    return parsed.select("record.*", *[typed.get(c, F.col(c)) for c in records.columns if c != "record"])


def _joined(pieces: str, value: str) -> Column:
    return F.array_join(F.transform(F.array_sort(pieces), lambda p: p[value]), "\n")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, partition columns of the folders): the text of every record but the files' headers.

    Blank lines outside quotes are no records.  A quote that is never closed takes the rest of its file in one record,
    as in Spark's own reader."""
    text = spark.read.option("lineSep", "\n").text(path)
    folders = [c for c in text.columns if c != "value"]
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = text.select(*folders, "value", quotes.alias("quotes"), F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_block_start").alias("_split"),
                        F.monotonically_increasing_id().alias("_line"))   # grows along a split
    # one row per split
    before = W.partitionBy("_file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    splits = (lines.groupBy(*_AT).agg(F.sum("quotes").alias("quotes"))
              .select(*_AT, F.coalesce(F.sum("quotes").over(before), F.lit(0)).alias("_before")))
    inside = W.partitionBy(*_AT).orderBy("_line")
    earlier = F.coalesce(F.sum("quotes").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    lines = lines.join(splits, _AT).withColumn("_starts", (F.col("_before") + earlier) % 2 == 0)
    # the running number of a split's records; 0 for the end of one that began in an earlier split
    lines = lines.withColumn("_record", F.sum(F.col("_starts").cast("int")).over(inside))
    fragments = lines.groupBy(*folders, *_AT, "_record").agg(
        _joined(F.collect_list(F.struct("_line", "value")), "value").alias("record"),
        ((F.sum("quotes") + (F.max("_record") == 0).cast("int")) % 2 == 1).alias("_open"))
    fragments = fragments.withColumn("_header", (F.col("_split") == 0) & (F.col("_record") == 1))
    whole = fragments.where((F.col("_record") > 0) & ~F.col("_open"))
    # at most the first and the last fragment of a split
    cut = fragments.where((F.col("_record") == 0) | F.col("_open"))
    nth = F.sum((F.col("_record") > 0).cast("int")).over(W.partitionBy("_file").orderBy("_split", "_record"))
    stitched = cut.withColumn("_nth", nth).groupBy(*folders, "_file", "_nth").agg(
        _joined(F.collect_list(F.struct("_split", "_record", "record")), "record").alias("record"),
        F.bool_or("_header").alias("_header"))
    columns = ["record", *folders, "_header"]
    records = whole.select(columns).unionByName(stitched.select(columns))
    return records.where(~F.col("_header") & (F.col("record") != "")).drop("_header")
