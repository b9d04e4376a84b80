from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from jobnest.session import get_session

    s = get_session("local[*]", shuffle_partitions=8, app_name="jobnest-tests")
    # tests pick their own shared folder only because none is configured
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        d = tempfile.mkdtemp(prefix="jobnest-tests-")
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


def bodies(spark, docs, col="body", **extra):
    """One-column frame of JSON text bodies (plus constant extra columns per row)."""
    import json

    rows = []
    for i, d in enumerate(docs):
        text = d if isinstance(d, str) else json.dumps(d)
        rows.append((i, text, *[v[i] if isinstance(v, list) else v for v in extra.values()]))
    cols = ["_i", col, *extra.keys()]
    return spark.createDataFrame(rows, cols)
