"""Steps that would change nothing are left out, and results stay the same."""

import datetime as dt
import random

from cohortflow import config as C
from cohortflow.operators import eligibility, overrides
from cohortflow.sources.schedules import schedule_frame

DAY, BASE = dt.timedelta(days=1), dt.date(2020, 1, 1)
ANTIGENS = "person_id long, antigen_code string, antigen_dose string, event_date date"
PRODUCTS = "person_id long, vaccine_code string, vaccine_part string, vaccine_desc string, vaccine_text string, event_date date"
EXPANDED = ("person_id long, dob date, rule_ref int, prev_ref int, antigen string, product string, stage string, "
            "doses_required int, va_date date, window_start date, window_end date")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stored_events_and_rules_of_their_own_are_not_grouped(small_pipeline):
    assert small_pipeline.src.by_person
    assert "count(1)" not in _plan(small_pipeline.event_counts)
    assert "valid_doses_given" not in "".join(x for x in _plan(small_pipeline.counted).split("\n") if "Aggregate" in x)


def test_uncombined_events_give_the_same_counts(spark):
    rng = random.Random(3)
    raw = [(p, rng.choice(["DIPH", "HIB", "TET", None]), rng.choice(["1P", "1B", None]), rng.choice([None, *(BASE + k * DAY for k in range(4))]))
           for p in (1, 2) for _ in range(200)]
    ba = spark.createDataFrame(raw, ANTIGENS)
    bp = spark.createDataFrame([(1, C.BOOSTER_PRODUCT_CODE, "1P", None, None, BASE + k * DAY) for k in (0, 0, 2)], PRODUCTS)
    combined, plain = (eligibility.clean_event_days(ba, bp, combine=c) for c in (True, False))
    assert _rows(eligibility.clean_events(plain)) == _rows(eligibility.clean_events(combined))
    assert plain.count() > combined.count()
    assert _rows(eligibility.running_counts(eligibility.event_counts(plain))) == _rows(eligibility.running_counts(eligibility.event_counts(combined)))


def test_rules_that_differ_only_in_windows_are_still_summed(spark):
    rules = schedule_frame(spark)
    assert not eligibility.has_alike_rules(rules)
    assert not eligibility.has_alike_rules(rules.union(rules))  # a rule listed twice is one rule
    assert eligibility.has_alike_rules(rules.union(rules.limit(1).selectExpr(*["count_to_value + 1 AS count_to_value" if c == "count_to_value" else c for c in rules.columns])))
    counts = spark.createDataFrame([(1, "A", BASE + k * DAY, 2) for k in range(5)], "person_id long, antigen_norm string, event_date date, n_events long")
    one = (1, BASE, 7, None, "A", "P", "S", 1, BASE)
    rows = [(*one, BASE, BASE + DAY), (*one, BASE, BASE + 9 * DAY), (2, BASE, None, None, None, None, None, None, BASE, None, None)]
    alike = spark.createDataFrame(rows, EXPANDED)
    assert sorted(r.valid_doses_given for r in eligibility.count_in_window(alike, counts).collect()) == [0, 14]
    own = spark.createDataFrame(rows[1:], EXPANDED)
    plain = eligibility.count_in_window(own, counts, alike=False)
    assert _rows(plain) == _rows(eligibility.count_in_window(own, counts)) and plain.dtypes == eligibility.count_in_window(own, counts).dtypes


def test_override_flags_do_not_compute_the_history(small_pipeline):
    assert "collect_set" not in _plan(small_pipeline.person_flags)
    assert "collect_set" in _plan(small_pipeline.event_summary)
    n = len(small_pipeline.stages.paths)
    assert small_pipeline.event_history is small_pipeline.event_history and len(small_pipeline.stages.paths) <= n + 1
    assert "collect_set" not in _plan(small_pipeline.event_history)  # stored


def test_acwy_counts_for_the_earliest_of_several_births(spark):
    late = 7 * C.DEFAULT_POLICY.acwy_valid_from_weeks
    am = spark.createDataFrame([(i, BASE, "HIB", 1) for i in range(6)], "person_id long, dob date, antigen string, met_flag int")
    events = spark.createDataFrame([(i, None, "X", C.ACWY_DESCRIPTION, "X", BASE + late * DAY) for i in (0, 1, 2, 3, 5)], PRODUCTS)
    demo = spark.createDataFrame([(0, BASE), (0, BASE + 9 * DAY), (1, BASE + DAY), (2, None), (2, BASE), (4, BASE), (5, None)], "person_id long, dob date")
    caveats = spark.createDataFrame([], "person_id long, cohort int")
    got = overrides.person_flags(am, caveats, overrides.event_summary(events), demo).collect()
    assert {r.person_id: r.acwy_ok for r in got} == {0: 1, 1: None, 2: 1, 3: None, 4: None, 5: None}
