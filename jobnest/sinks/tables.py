"""K2 full-replace loads with audit timestamp (K5) and load shape (A3); K3 one table per name; K6 batches."""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from jobnest.functions.scalars import audit_timestamp
from jobnest.operators.indexing import with_row_index
from jobnest.session import work_root

# Fixed values (must equal the original's): the audit column of every raw table,
# and the one table that names it differently.
AUDIT_COL = "process_dttm"
STATION_AUDIT_COL = "raw_timestamp"

#: Number of a row in a sorted table.
ORDER_COL = "row_order"

#: Prefix of the folders that hold one load of a table each.
VERSION = "version_"


def ensure_schema(spark: SparkSession, schema: str) -> str:
    """Create the schema with its location under the shared folder."""
    if not spark.catalog.databaseExists(schema):
        loc = work_root(spark, "warehouse", schema)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{loc}'")
    return schema


#: Raw tables of the library itself; names from data never take them.
FIXED_TABLES = tuple(t + bad for t in ("areas", "metro_lines", "metro_stations", "vacancies", "employers", "employer_batches")
                     for bad in ("", "_bad"))


def safe_name(name: str) -> str:
    """A table name taken from data, in ``[a-z0-9_]``; different names never share a table.

    A name that is no such name already, or that belongs to a fixed table, gets a digest of itself at its end.
    """
    plain = re.sub(r"[^0-9a-z_]", "_", name.lower())
    if plain == name and name and name not in FIXED_TABLES and not re.search(r"__[0-9a-f]{10}$", name):
        return name
    return f"{plain}__{hashlib.sha256(name.encode()).hexdigest()[:10]}"


def with_audit(df: DataFrame, run_ts: str | dt.datetime, audit_col: str = AUDIT_COL) -> DataFrame:
    """One constant audit instant for the whole load."""
    return df.withColumn(audit_col, audit_timestamp(run_ts))


def replace_load(df: DataFrame, schema: str, table: str, run_ts: str | dt.datetime,
                 audit_col: str = AUDIT_COL, partition_by: list[str] | None = None) -> dict:
    """K2 + K5 + A3: replace ``schema.table``; report rows/columns from the write itself.

    The rows go to a version folder of their own; only when they are all written does the table point there.  Readers
    that have begun, and everyone after a load that failed, see the version before, and a load may read the table it
    replaces.  The version before stays on disk, older ones are removed.  The row count is an ``Observation`` on the
    written data, so no second pass over the input is needed.
    """
    spark = df.sparkSession
    ensure_schema(spark, schema)
    obs = Observation(f"load_{schema}_{table}")
    out = with_audit(df, run_ts, audit_col).observe(obs, F.count(F.lit(1)).alias("rows"))
    base = spark.catalog.getDatabase(schema).locationUri.rstrip("/") + f"/{table}"
    version = f"{base}/{VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    writer = out.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(version)
    point_table(spark, schema, table, out.schema, version, partition_by)
    expire_versions(spark, base)
    return {"table": f"{schema}.{table}", "rows": obs.get["rows"], "columns": len(out.columns)}


def sorted_load(df: DataFrame, schema: str, table: str, run_ts: str | dt.datetime, order_cols: list[str],
                audit_col: str = AUDIT_COL) -> dict:
    """K2 + O1/O2: as :func:`replace_load`, with the rows in order on disk.

    Rows are dealt by ranges of ``order_cols`` (the other columns break ties) and sorted in their range; ``ORDER_COL``
    numbers them from 0 across all files.  A reader gets the order back from that column, and file statistics on the
    order columns let a scan skip files.  ``broken_order`` checks the layout.
    """
    rest = [f.name for f in df.schema.fields if f.name not in order_cols and not isinstance(f.dataType, T.MapType)]
    return replace_load(with_row_index(df, [*order_cols, *rest], index_col=ORDER_COL), schema, table, run_ts, audit_col)


def broken_order(rows: DataFrame, order_cols: list[str]) -> DataFrame:
    """Places where a sorted table's layout is broken: (file, reason); no rows if all is in order.

    Inside a file every row must continue the one before it; across files the ranges of ``ORDER_COL`` must meet without
    gap or overlap and the order columns must not run back.  Only one row per file is compared across files."""
    key = F.struct(*order_cols)
    spot = F.col("_metadata.row_index")
    each = rows.select(F.col("_metadata.file_path").alias("file"), F.col(ORDER_COL).alias("at"), spot.alias("spot"), key.alias("key"))
    files = each.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi"),
                                     F.countDistinct(F.col("at") - F.col("spot")).alias("steps"),
                                     F.min("key").alias("key_lo"), F.max("key").alias("key_hi"),
                                     F.min_by("key", "spot").alias("first"), F.max_by("key", "spot").alias("last"))
    across = Window.orderBy("lo")
    files = files.withColumn("before", F.lag("hi").over(across)).withColumn("key_before", F.lag("key_hi").over(across))
    reason = (F.when((F.col("steps") != 1) | (F.col("hi") - F.col("lo") + 1 != F.col("n")), "rows out of order")
              .when((F.col("first") != F.col("key_lo")) | (F.col("last") != F.col("key_hi")), "keys out of order")
              .when(F.col("lo") != F.coalesce(F.col("before") + 1, F.lit(0)), "gap or overlap")
              .when(F.col("key_before") > F.col("key_lo"), "keys run back"))
    return files.select("file", reason.alias("reason")).where(F.col("reason").isNotNull())


def point_table(spark: SparkSession, schema: str, table: str, columns: T.StructType, location: str,
                partition_by: list[str] | None = None) -> None:
    """The table, made or changed to show the Parquet files at ``location``; catalogue work only, no file is touched."""
    name = f"`{schema}`.`{table}`"
    last = partition_by or []
    fields = [f for f in columns.fields if f.name not in last] + [f for f in columns.fields if f.name in last]
    same = spark.catalog.tableExists(f"{schema}.{table}") and not last and [
        (f.name, f.dataType) for f in spark.table(name).schema.fields] == [(f.name, f.dataType) for f in fields]
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
        return
    # other columns, or partitions to list anew: files are external, so dropping the entry removes none of them
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ddl = T.StructType([T.StructField(f.name, f.dataType) for f in fields]).toDDL()
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in last)})" if last else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{parts} LOCATION '{location}'")
    if last:
        spark.catalog.recoverPartitions(name)


def expire_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Removes the version folders before the newest ``keep`` complete ones; their names tell their order, and a load that
    is still being written has a later name."""
    jvm = spark.sparkContext._jvm   # Spark has no call of its own that removes a folder of a shared store
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in fs.listStatus(path(base)) if f.getPath().getName().startswith(VERSION))
    complete = [n for n in names if fs.exists(path(f"{base}/{n}/_SUCCESS"))]
    old = [n for n in names if n < complete[-keep:][0]] if complete else []
    for n in old:
        fs.delete(path(f"{base}/{n}"), True)
    return old


def write_batches(batches: DataFrame, path: str) -> None:
    """K6: persist id batches as named parts (``part=N`` folders)."""
    batches.write.mode("overwrite").partitionBy("part").parquet(path)


def replace_jdbc(df: DataFrame, url: str, table: str, run_ts: str | dt.datetime,
                 properties: dict[str, str] | None = None, audit_col: str = AUDIT_COL,
                 num_partitions: int | None = None) -> None:
    """K2 + K5 into a relational database: full replace through Spark's JDBC writer.

    ``truncate`` keeps the target's definition (grants, indexes) while replacing rows;
    ``num_partitions`` bounds the number of concurrent connections.
    """
    out = with_audit(df, run_ts, audit_col)
    if num_partitions:
        out = out.coalesce(num_partitions)
    (out.write.format("jdbc").option("url", url).option("dbtable", table).option("truncate", "true")
     .options(**(properties or {})).mode("overwrite").save())


LOG_SCHEMA = "run string, table string, rows long, columns long, rejects long, loaded_at timestamp"


def log_loads(spark: SparkSession, path: str, run: str, stats: list[dict], run_ts: str | dt.datetime) -> None:
    """A3: the observed shape of a run's loads, appended to the log at ``path``; one write for all of them."""
    if not stats:
        return
    rows = [(run, s["table"], s["rows"], s["columns"], s.get("bad_rows", 0)) for s in stats]
    log = spark.createDataFrame(rows, "run string, table string, rows long, columns long, rejects long")
    log.withColumn("loaded_at", audit_timestamp(run_ts)).coalesce(1).write.mode("append").parquet(path)


def load_log(spark: SparkSession, path: str) -> DataFrame:
    """The log of all runs so far; of a load that a repeated run logged again, the last entry counts."""
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    last = log.groupBy("run", "table").agg(F.max(F.struct("loaded_at", "rows", "columns", "rejects")).alias("l"))
    return last.select("run", "table", "l.rows", "l.columns", "l.rejects", "l.loaded_at")
