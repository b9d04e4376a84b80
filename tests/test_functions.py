"""Scalar helpers E3-E13."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from jobnest.functions import scalars as X


def test_scalar_helpers(spark):
    r = spark.range(1).select(
        X.dotted_component(F.lit("12.345.6")).alias("e4"),
        X.dotted_component(F.lit("nodot"), strict=False).alias("e4_lenient"),
        X.url_key("employers", F.lit(42.0)).alias("e5"),
        X.split_list_param("data engineer, data analyst").alias("e8"),
        X.translate_name(F.lit("data engineer [x]")).alias("e9"),
        X.day_before("2024-03-01").alias("e10"),
        X.month_before("2024-03-31").alias("e13"),
        X.strict_long(F.lit("01")).alias("e3"),
    ).first()
    assert r["e4"] == "345" and r["e4_lenient"] is None
    assert r["e5"] == "employers/42"
    assert r["e8"] == ["data engineer", "data analyst"]
    assert r["e9"] == "data_engineer_x"
    assert str(r["e10"]) == "2024-02-29" and str(r["e13"]) == "2024-02-29"
    assert r["e3"] == 1


@pytest.mark.parametrize("bad", ["abc", None])
def test_strict_long_raises(spark, bad):
    with pytest.raises(Exception):
        spark.range(1).select(X.strict_long(F.lit(bad).cast("string"))).collect()
