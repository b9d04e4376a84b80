"""Plan tests: pushdown and pruning reach the scan; no data-sized single-partition stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from jobnest.plans import landing as L
from jobnest.plans import queries as Q
from jobnest.session import work_root


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_landed_scan_prunes_columns(spark):
    """The projection reads only the body column of the landed vacancies."""
    from jobnest.operators.vacancies import vacancy_project
    landed = L.landed(spark, SF_SMALL, "vacancies")
    plan = _plan(vacancy_project(landed.select("body")))
    assert "ReadSchema: struct<body:string>" in plan


def test_filter_on_raw_table_is_pushed_down(spark):
    path = work_root(spark, "t", "raw_vac", unique=True)
    Q.vacancy_project(spark, SF_SMALL).write.parquet(path)
    plan = _plan(spark.read.parquet(path).where(F.col("area") == 22).select("id", "name"))
    assert "PushedFilters: [IsNotNull(area), EqualTo(area,22)]" in plan
    assert "ReadSchema: struct<id:bigint,name:string,area:bigint>" in plan


def test_no_single_partition_stage_over_data(spark):
    for q in (Q.employer_batches, Q.page_assign, Q.area_preorder):
        plan = _plan(q(spark, SF_SMALL))
        # the only un-partitioned window runs over the per-range count table
        for line in plan.splitlines():
            if "SinglePartition" in line:
                assert "_rp" in plan


def test_search_terms_are_a_generator_not_a_join(spark):
    plan = _plan(Q.search_groups(spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Generate explode" in plan


def test_projections_do_not_shuffle(spark):
    """Document projections stream scan -> parse -> rows: no exchange, no Python."""
    for q in (Q.vacancy_project, Q.vacancy_quarantine, Q.metro_stations, Q.dictionary_normalize,
              Q.props_normalize, Q.employer_project):
        plan = _plan(q(spark, SF_SMALL))
        assert "Exchange" not in plan, q.__name__
        assert "Python" not in plan and "ArrowEval" not in plan, q.__name__


def test_command_line_lists_and_runs(spark, capsys):
    from jobnest.__main__ import main
    assert main(["queries"]) == 0
    listed = capsys.readouterr().out
    assert "vacancies_by_root_area" in listed and "clean_areas" in listed
    assert main(["run", "area_roots", SF_SMALL, "--show", "2"]) == 0
    assert "area_id" in capsys.readouterr().out


def test_aggregations_are_two_phase(spark):
    """Every grouping pre-aggregates map-side: a partial aggregate sits below the exchange."""
    import re
    for q in (Q.vacancies_by_root_area, Q.search_counts, Q.dictionary_keys, Q.employer_ids, Q.metro_lines):
        plan = _plan(q(spark, SF_SMALL))
        lines = plan.splitlines()
        exch = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
        assert exch, q.__name__
        below = "\n".join(lines[exch[0]:])
        assert re.search(r"(HashAggregate|ObjectHashAggregate|SortAggregate)\(keys?=\[[^\]]*\], functions=\[(partial_|\])", below), \
            q.__name__
