"""Jobs survive failed task attempts: failures are injected into first attempts and results stay exact.

Runs in its own process because task retries need a ``local[N,maxFailures]`` master.
"""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import json, sys
sys.path.insert(0, ROOT)
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F, types as T
from jobnest.operators.indexing import with_row_index
from jobnest.operators.trees import area_flatten

spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "6").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
spark.sparkContext.setCheckpointDir(CKPT)

@F.udf(T.LongType())          # test-only fault injection: first attempt of even partitions dies
def flaky(x):
    tc = TaskContext.get()
    if tc is not None and tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
        open(f"{CKPT}/failed-{tc.stageId()}-{tc.partitionId()}", "w").close()   # proof of injection
        raise RuntimeError("simulated lost task")
    return x

df = spark.range(0, 3000, numPartitions=6).select(
    F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("g"), flaky("id").alias("k"))
rows = with_row_index(df, ["k"], ["g"], "i", num_ranges=5).collect()
ok = True
for g in ("hot", "cold"):
    ks = sorted((r["i"], r["k"]) for r in rows if r["g"] == g)
    ok &= [i for i, _ in ks] == list(range(len(ks))) and [k for _, k in ks] == sorted(k for _, k in ks)

def node(i, kids):
    return {"id": i, "parent_id": None, "name": "n", "areas": kids}
trees = [json.dumps(node(f"r{r}", [node(f"c{r}.{c}", [node(f"l{r}.{c}.{l}", []) for l in range(3)])
                                   for c in range(4)])) for r in range(40)]
bodies = spark.createDataFrame([(i, t) for i, t in enumerate(trees)], "k long, body string") \
    .withColumn("k", flaky("k"))
flat = area_flatten(bodies, root_order_col="k")
ok &= flat.count() == 40 * (1 + 4 + 12) and flat.select("area_id").distinct().count() == 40 * 17
import glob
injected = len(glob.glob(f"{CKPT}/failed-*"))
print("INJECTED", injected)
print("RESULT", "OK" if ok and injected > 0 else "WRONG")
'''


def test_results_exact_after_task_retries():
    ckpt = tempfile.mkdtemp(prefix="jobnest-retry-")
    code = SCRIPT.replace("ROOT", repr(ROOT)).replace("{CKPT}", ckpt).replace("CKPT", repr(ckpt))
    proc = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=900)
    assert "RESULT OK" in proc.stdout, proc.stdout[-2000:] + proc.stderr[-3000:]


LOAD = r'''
import sys
sys.path.insert(0, __ROOT__)
from pyspark.sql import SparkSession
from jobnest.sinks.tables import replace_load
from jobnest.sources.catalog import read_table
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", __SHARED__).getOrCreate())
spark.sparkContext.setLogLevel("OFF")
replace_load(spark.range(__N__).toDF("k"), "raw", "t", "2024-04-23 05:05:00")
print("ROWS", read_table(spark, "raw", "t").count())
'''


def test_full_replace_load_across_sessions():
    """A new session (fresh catalogue) replaces the files an earlier session left in the shared folder."""
    shared = tempfile.mkdtemp(prefix="jobnest-shared-")
    outs = []
    for n in (3, 5):
        code = (LOAD.replace("__ROOT__", repr(ROOT)).replace("__SHARED__", repr(shared))
                .replace("__N__", str(n)))
        proc = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
        outs.append(proc.stdout)
        assert f"ROWS {n}" in proc.stdout, proc.stdout[-1000:] + proc.stderr[-2000:]
