"""Stage-level cases: expansion, hot and missing keys, mixed case, overrides, outputs."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.operators import dosing, eligibility, overrides, report
from cohortflow.plans import catalog
from cohortflow.plans.pipeline import ReportPipeline
from cohortflow.sources.fixtures import derive_sources
from cohortflow.sources.schedules import (ANY_MMR_SCHEDULE, TEST_SCHEDULE, normalised_rules,
                                          schedule_frame)

SF_SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
POLICY = C.DEFAULT_POLICY


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lazy(spark):
    """A pipeline without any checkpoint, so its plans show everything."""
    src = derive_sources(spark, SF_SMALL, POLICY.as_of, materialize=False)
    return ReportPipeline(src, schedule_frame(spark), POLICY, products=catalog.schedule_products(), materialize=False)


@pytest.fixture(scope="module")
def full(spark):
    return catalog.pipeline(spark, SF)


def test_rules_that_start_later_or_never_end(spark, lazy):
    """A rule whose validity begins after the report date is due for nobody and harms nothing."""
    more = TEST_SCHEDULE + "90||DIPH|1|4IN1|Preschool|W0|Y20||W0|Y20|2027-06-01|\n91||DIPH|1|4IN1|Preschool|W0|Y20||W0|Y20|2030-01-01|2031-01-01\n"
    src = lazy.src.population
    old = eligibility.expand_rules(src, schedule_frame(spark), POLICY.as_of)
    new = eligibility.expand_rules(src, schedule_frame(spark, more), POLICY.as_of)
    assert _rows(old) == _rows(new)


def test_expansion_against_plain_join(spark, lazy):
    """Resolving rules by date of birth gives what joining every person with every rule gives."""
    pop, rules = lazy.src.population, schedule_frame(spark)
    from cohortflow.functions.dates import add_age_sql
    a = f"DATE'{POLICY.as_of}'"
    cond = F.expr(f"{a} >= {add_age_sql('dob', 'due_from_value', 'due_from_unit')} AND dob BETWEEN valid_from AND coalesce(valid_to, {a})")
    people = eligibility.in_scope_people(pop, POLICY.as_of).distinct()
    plain = people.join(F.broadcast(rules), cond, "left").select("person_id", "rule_ref")
    assert _rows(eligibility.expand_rules(pop, rules, POLICY.as_of).select("person_id", "rule_ref")) == _rows(plain)


def test_too_many_rules_are_refused(spark, lazy):
    import dataclasses
    with pytest.raises(ValueError, match="max_rules"):
        ReportPipeline(lazy.src, schedule_frame(spark), dataclasses.replace(POLICY, max_rules=10))


def test_expanded_rows_are_not_shuffled_again(lazy):
    """From the expansion to the met flags people stay where they were dealt; the exchanges are
    those of the people, of the events, and of the small frames that get broadcast."""
    plan = _plan(lazy.antigens_met)
    counting = plan.index("SortMergeJoin")
    assert "Exchange" not in plan[:counting]
    expansion = plan.index("explode(due")
    assert "Exchange" not in plan[counting:expansion]
    assert re.search(r"Exchange hashpartitioning\(person_id#\d+L?, \d+\), REPARTITION_BY_COL", plan[expansion:])
    assert not re.search(r"Exchange hashpartitioning\([^)]*rule_ref#\d+, \d+\)", plan[:expansion])


def test_exchanges_of_the_uncut_plan_are_bounded(lazy):
    assert _plan(lazy.status_base).count("Exchange hashpartitioning") <= 30
    assert "CartesianProduct" not in _plan(lazy.counted)


def test_hot_person_day(spark):
    """Thousands of equal events of one person are days before anything joins them."""
    d = dt.date(2020, 1, 1)
    ba = spark.createDataFrame([(1, "DIPH", "1P", d)] * 3000 + [(1, "HIB", "1P", d)] * 50 + [(2, "DIPH", "1B", d)], "person_id long, antigen_code string, antigen_dose string, event_date date")
    bp = spark.createDataFrame([(1, "4IN1", "1P", "4IN1", d)] * 2000, "person_id long, vaccine_code string, vaccine_part string, vaccine_desc string, event_date date")
    days = eligibility.clean_event_days(ba, bp)
    assert sorted((r.person_id, r.antigen_code, r.n_events) for r in days.collect()) == [(1, "HIB", 50), (2, "DIPH", 1)]
    assert eligibility.clean_events(days).count() == 51
    plan = _plan(days)
    join = plan.index("SortMergeJoin")
    assert "partial_count" in plan[join:]


def test_hot_and_missing_dimension_keys(spark, lazy):
    rows = [(i, "gp" if i % 2 else None) for i in range(500)]
    core = spark.createDataFrame([(i, "1.1") for i in range(500)], "person_id long, HPV string")
    pop = spark.createDataFrame([(i, dt.date(2020, 1, 1), POLICY.as_of, "f", "s", "M", None, g, None, None) for i, g in rows],
                                "person_id long, dob date, va_date date, forename string, surname string, gender string, postcode string, gp_code string, ccg_code string, la_code string")
    gp = spark.createDataFrame([("gp", "The practice", "East", None, "1", "P")] * 2, lazy.src.gp.schema)
    s = lazy.src
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    out = report.demographics_star(core, pop, s.demographics, gp, s.la, s.postcodes, s.deprivation, s.schools)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before  # building it starts no job
    got = out.groupBy("practice_name", "registered_in_area").count().collect()
    assert sorted((r.practice_name or "", r.registered_in_area, r["count"]) for r in got) == [("", 0, 250), ("The practice", 1, 250)]


def test_rules_in_other_case(spark, lazy):
    low = schedule_frame(spark).withColumns({"antigen": F.lower("antigen"), "product": F.concat(F.lit(" "), F.lower("product")),
                                             "stage": F.upper("stage"), "due_from_unit": F.upper("due_from_unit")})
    names = {r.product for r in normalised_rules(low).collect()}
    assert {C.PRODUCT_MMR_1, C.PRODUCT_MMRV_2, C.PRODUCT_SIX_IN_ONE_18M, C.PRODUCT_ROTA} <= names
    p = ReportPipeline(lazy.src, low, POLICY, products=catalog.schedule_products(), materialize=False)
    same = [c for c in lazy.antigens_met.columns if c not in ("product", "stage")]
    assert _rows(p.antigens_met.select(same)) == _rows(lazy.antigens_met.select(same))


def test_history_shows_codes_as_given(full):
    texts = [r.imms_history for r in full.event_summary.select("imms_history").collect()]
    assert any("mmr - " in t for t in texts) and any("MMR - " in t for t in texts)


def test_product_in_two_stages_does_not_multiply(spark, full):
    two = full.status_base.where(F.col("product") == C.PRODUCT_MMR_1).groupBy("person_id").count().where("count > 1")
    assert two.count() > 0
    assert full.product_status.count() == full.status_base.count()
    status = spark.createDataFrame([(1, C.PRODUCT_MMR_1, "12 Month", 1, 1), (1, C.PRODUCT_MMR_1, "Preschool", 1, 1)], full.status_base.select("person_id", "product", "stage", "min_met", "still_needed").schema)
    doses = spark.createDataFrame([(1, C.PRODUCT_MMR_1, 1, 1), (1, C.PRODUCT_MMR_1, 1, 2)], "person_id long, product string, doses_given int, doses_required int")
    flags = spark.createDataFrame([], full.person_flags.schema)
    got = overrides.product_overrides(status, flags, doses).collect()
    assert [(r.stage, r.min_met) for r in sorted(got, key=lambda r: r.stage)] == [("12 Month", 0), ("Preschool", 0)]


def test_status_rows_get_their_doses_without_an_exchange_by_product(spark, full):
    """The status rows stay dealt by person, also in a session that wants all join keys in a partitioning."""
    products = [C.PRODUCT_MMR_1, C.PRODUCT_MMR_2, C.PRODUCT_ROTA, None]
    status = spark.createDataFrame([(i, p, "12 Month", 0, 1) for i in range(3) for p in products], "person_id long, product string, stage string, min_met int, still_needed int")
    doses = spark.createDataFrame([(0, C.PRODUCT_MMR_1, 1, 1), (0, C.PRODUCT_MMR_1, None, 2), (0, C.PRODUCT_MMR_2, 0, None), (1, C.PRODUCT_MMR_2, None, 1),
                                   (1, C.PRODUCT_ROTA, 2, 2), (2, None, 5, 5)], "person_id long, product string, doses_given int, doses_required int")
    flags = spark.createDataFrame([], full.person_flags.schema)
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        rows = overrides.with_person_facts(status, flags, doses)
        assert not re.search(r"hashpartitioning\(\w*person\w*#\d+L?, \w*product", _plan(rows))
        got = {(r.person_id, r.product): (r.doses_given, r.doses_required) for r in rows.collect()}
        assert rows.count() == len(got) == 12
    finally:
        spark.conf.set(name, before)
    held = {(0, C.PRODUCT_MMR_1): (1, 2), (0, C.PRODUCT_MMR_2): (0, None), (1, C.PRODUCT_MMR_2): (None, 1)}
    assert got == {(i, p): held.get((i, p), (None, None)) for i in range(3) for p in products}


def test_every_product_override_changes_rows(full):
    rows = overrides.with_person_facts(full.status_base, full.person_flags, full.doses)
    out = {}
    for name, _, assignments in overrides.product_steps():
        after = rows.withColumns({f"new_{k}": F.expr(v) for k, v in assignments.items()})
        differs = " OR ".join(f"NOT ({k} <=> new_{k})" for k in assignments)
        out[name] = after.where(differs).count()
        rows = after.withColumns({k: F.col(f"new_{k}") for k in assignments}).drop(*[f"new_{k}" for k in assignments])
    assert all(n > 0 for n in out.values()), out


def test_every_antigen_override_changes_rows(spark, full):
    p = catalog.pipeline(spark, SF, schedule=ANY_MMR_SCHEDULE)
    met = p.antigens_met
    steps = [("O3/O4", met, overrides.menb_override(met))]
    steps.append(("O5", steps[-1][2], overrides.age_waiver(steps[-1][2])))
    keys = ["person_id", "antigen", "product", "stage", "rule_ref"]
    final = overrides.series_overrides(steps[-1][2], p.caveats)
    changed = {n: len(set(_rows(b.select(a.columns))) - set(_rows(a))) for n, a, b in steps}
    old = {tuple(r[k] for k in keys): (r.valid_doses_given, r.met_flag) for r in steps[-1][2].collect()}
    for r in final.collect():
        if old[tuple(r[k] for k in keys)] != (r.valid_doses_given, r.met_flag):
            changed[r.product] = changed.get(r.product, 0) + 1
    assert {"O3/O4", "O5", C.PRODUCT_MMR_ANY_1, C.PRODUCT_MMR_1, C.PRODUCT_MMRV_1, C.PRODUCT_MMRV_2} <= {k for k, n in changed.items() if n}, changed


def test_hpv_waiver_changes_rows(full):
    a, b = _rows(full.product_status), _rows(full.final_status.select(full.product_status.columns))
    assert len(a) == len(b) and a != b


def test_takeover_antigens(spark):
    assert {r.antigen for r in dosing.takeover_antigens(schedule_frame(spark)).collect()} == {"PCV", "MENB"}


def test_write_outputs_is_idempotent(spark, small_pipeline, tmp_path):
    from cohortflow.plans.pipeline import OUTPUTS, write_outputs
    base = str(tmp_path / "out")
    write_outputs(small_pipeline, base)
    paths = write_outputs(small_pipeline, base)      # second run replaces the first
    assert set(paths) == set(OUTPUTS)
    rep = spark.read.parquet(paths["report"])
    assert rep.count() == small_pipeline.full_report.count() == rep.select("row_id").distinct().count()
    assert "row_id" not in small_pipeline.full_report.columns
    assert spark.read.parquet(paths["doses_given"]).count() == rep.count()
