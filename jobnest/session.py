"""Session construction and shared-folder helpers.

Cluster jobs must not write to machine-local temporary folders.  Everything
this package persists (staging text, raw/clean tables, streaming checkpoints,
lineage cuts) goes under the shared folder named by ``spark.checkpoint.dir``.
Without that setting a local master (tests, the bench) gets a scratch folder;
any other one raises.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce post-shuffle partitions to the advisory size, not to many tiny tasks
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what is provably small; AQE may still convert at runtime
    # from measured shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # lineage cuts are removed from the shared folder once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "jobnest", extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():   # caller settings win
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder from ``spark.checkpoint.dir``; set a scratch one only if unset."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="jobnest-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def work_root(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder below the shared root; ``unique`` appends a fresh run id."""
    base = checkpoint_root(spark)
    path = "/".join([base, "jobnest", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain-file helpers (tests) can use a path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
