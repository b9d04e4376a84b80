"""Landed API bodies (S1-S4 re-aimed: the fetch itself is out of scope).

A landing folder holds either one response body per file (``wholetext``) or
JSON lines (one document per line).  Both come back as a ``body`` STRING
column plus the file it came from; parsing happens later with ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_bodies(spark: SparkSession, path: str, whole_text: bool = True) -> DataFrame:
    """One row per landed body (``whole_text``) or per JSON line."""
    df = spark.read.text(path, wholetext=whole_text)
    return df.select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("source_file"))


def read_keyed_bodies(spark: SparkSession, path: str, key_col: str = "url") -> DataFrame:
    """Landed detail documents stored as (key, body) Parquet, e.g. url -> vacancy."""
    return spark.read.parquet(path).select(key_col, "body")


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str | None = None) -> DataFrame:
    """S1 for a response that is one JSON array: one row per top-level element.

    The JSON reader streams the array element by element, so no single string
    holds the whole response (``wholetext`` would, and rows cap at 2 GB).
    ``root_order`` keeps each element's position for pre-order output.
    ``corrupt_col`` names a field of ``schema`` that takes what can't be read.
    """
    reader = spark.read.schema(schema).option("multiLine", "true").option("mode", "PERMISSIVE")
    if corrupt_col:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    df = reader.json(path)
    return df.withColumn("root_order", F.monotonically_increasing_id())
