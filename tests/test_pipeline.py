"""End-to-end: oracle agreement on sf0.001, plan shape, invariants."""

import os
import re

import pytest
from pyspark.sql import functions as F

from cohortflow import config as C

SF_SMALL = "/root/testdata/sf0.001"
# A representative subset; set COHORTFLOW_ALL_ORACLES=1 to compare every query.
ORACLE_KEYS = ["clean_events_anti", "expand_rules_theta", "count_in_window", "allocate_doses",
               "dose_sequence", "caveat_flags", "series_overrides", "mmr_recheck",
               "demographics_star", "stage_flags", "suspension_text", "full_report",
               "slice_product_compliance"]


def _keys():
    from cohortflow.plans import catalog
    return list(catalog.QUERIES) if os.environ.get("COHORTFLOW_ALL_ORACLES") else ORACLE_KEYS


@pytest.mark.parametrize("name", _keys())
def test_query_matches_oracle(spark, name):
    from tools.compare import compare
    assert compare(spark, SF_SMALL, [name], verbose=False)[name] is True


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_no_python_and_no_cartesian(small_pipeline):
    plan = _plan(small_pipeline.full_report)
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas", plan)
    assert "CartesianProduct" not in plan


def test_expansion_and_counting_have_no_nested_loop(small_pipeline):
    assert "BroadcastNestedLoopJoin" not in _plan(small_pipeline.counted)


def test_report_invariants(small_pipeline):
    p = small_pipeline
    rep = p.full_report
    people = p.expanded.select("person_id").distinct().count()
    assert rep.count() == people == rep.select("person_id").distinct().count()
    states = {r.state for r in p.states.select("state").distinct().collect()}
    assert states <= {0, 1, 2}
    mmr1 = p.antigens_final.where(F.col("product") == C.PRODUCT_MMR_1)
    assert mmr1.where(F.col("valid_doses_given") > 1).count() == 0
    bad = rep.where((F.col("up_to_date") == "Yes") & F.col("imms_history").isNull()
                    & F.col("person_id").isin([r.person_id for r in p.src.events_by_antigen
                                               .select("person_id").distinct().collect()]))
    assert bad.count() == 0


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "up_to_date" in df.columns
