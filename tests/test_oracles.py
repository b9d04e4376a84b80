"""Every registered query against its DuckDB oracle on the smallest data set (sf0.01 runs in the driver)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from jobnest.plans.queries import QUERIES
from oracle_harness import compare, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, entry.queries()[name], entry.oracle_sql()[name], con)
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["root_area_id", "vacancies", "with_salary", "min_salary_from", "max_salary_from"]
    assert df.count() > 0
