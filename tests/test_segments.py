"""Segments of dates of birth, window counts by binary search, and plans of the expansion."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortflow.functions.dates import add_age_sql, latest_birth_sql
from cohortflow.operators import eligibility
from cohortflow.sources.schedules import RULE_SCHEMA

DAY = dt.timedelta(days=1)


@pytest.mark.parametrize("on", [dt.date(2027, 2, 15), dt.date(2027, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 2, 28), dt.date(2027, 4, 30), dt.date(2027, 3, 30), dt.date(2027, 12, 31)])
def test_latest_birth_against_every_day(spark, on):
    ages = [(0, "Week"), (9, "week"), (1, "Month"), (13, " MONTH "), (19, "Month"), (1, "Year"), (4, "year")]
    rows = [(v, u, on - k * DAY) for v, u in ages for k in range(1, 366 * 5, 1 if v < 2 else 3)]
    df = spark.createDataFrame(rows, "v int, u string, d date")
    wrong = df.where(f"({add_age_sql('d', 'v', 'u')} <= DATE'{on}') != (d <= {latest_birth_sql(on, 'v', 'u')})")
    assert wrong.count() == 0
    other = spark.sql(f"SELECT {latest_birth_sql(on, 1, 'CAST(NULL AS STRING)')} AS a, {latest_birth_sql(on, 1, repr('Day'))} AS b").first()
    assert (other.a, other.b) == (None, None)


def random_rules(rng, n):
    base = dt.date(2015, 1, 1)
    out = []
    for ref in range(n):
        first = None if rng.random() < 0.05 else base + rng.randrange(4000) * DAY
        last = None if rng.random() < 0.3 else base + rng.randrange(4000) * DAY
        unit = rng.choice(["Week", "Month", "Year", None, "Other"])
        out.append((ref, None, rng.choice("AB"), 1, "P", "S", unit, rng.randrange(1, 8), "Year", 20, None, "Week", rng.randrange(9), rng.choice(["Month", None]), rng.randrange(2, 50), first, last))
    return out + out[:2]


def test_segments_give_what_comparing_every_rule_gives(spark):
    rng = random.Random(5)
    as_of = dt.date(2025, 2, 28)
    rules = spark.createDataFrame(random_rules(rng, 60), RULE_SCHEMA)
    births = [dt.date(2014, 6, 1) + rng.randrange(4500) * DAY for _ in range(300)] + [dt.date(1900, 1, 1), dt.date(2040, 1, 1)]
    people = spark.createDataFrame([(i, d, as_of) for i, d in enumerate(births)] + [(0, births[0], as_of)], "person_id long, dob date, va_date date")
    due = F.expr(f"DATE'{as_of}' >= {add_age_sql('dob', 'due_from_value', 'due_from_unit')} AND dob BETWEEN valid_from AND coalesce(valid_to, DATE'{as_of}')")
    plain = eligibility.in_scope_people(people, as_of).distinct().join(rules.distinct(), due, "left").select("person_id", "rule_ref", "antigen")
    got = eligibility.expand_rules(people, rules, as_of)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(got.select("person_id", "rule_ref", "antigen")) == rows(plain)
    begins, segments = eligibility.due_segments(eligibility.rule_spans(eligibility.numbered_rules(rules), as_of))
    n = rules.distinct().count()
    assert begins.count() <= 2 * n + 1 and segments.count() <= 2 * n + 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_rules_and_no_people(spark):
    none = spark.createDataFrame([], RULE_SCHEMA)
    people = spark.createDataFrame([(1, dt.date(2020, 1, 1), None)], "person_id long, dob date, va_date date")
    got = eligibility.expand_rules(people, none, dt.date(2027, 1, 1)).collect()
    assert [(r.person_id, r.rule_ref, r.window_start) for r in got] == [(1, None, None)]
    assert eligibility.expand_rules(people.limit(0), none, dt.date(2027, 1, 1)).count() == 0


def test_windows_of_a_hot_person_are_counted_without_a_row_for_each_day(spark):
    rng = random.Random(6)
    base = dt.date(2000, 1, 1)
    days = [base + k * DAY for k in range(0, 9000, 2)]
    events = spark.createDataFrame([(1, "A", d, rng.randrange(1, 4)) for d in days] + [(2, "A", base, 5), (3, "B", None, 7)], "person_id long, antigen_norm string, event_date date, n_events long")
    windows = [(base + a * DAY, base + b * DAY) for a, b in [(0, 0), (-5, -1), (1, 1), (0, 8998), (8998, 8998), (8999, 9500), (-10, 20000), (5, 4)] + [sorted(rng.randrange(-50, 9100) for _ in "ab") for _ in range(200)]]
    windows += [(None, base), (base, None)]
    rule = [(p, base, i, None, "A", "P", "S", 1, None, s, e) for i, (s, e) in enumerate(windows) for p in (1, 2, 3)]
    expanded = spark.createDataFrame(rule, "person_id long, dob date, rule_ref int, prev_ref int, antigen string, product string, stage string, doses_required int, va_date date, window_start date, window_end date")
    got = {(r.person_id, r.rule_ref): r.valid_doses_given for r in eligibility.count_in_window(expanded, events).collect()}
    held = [(r.person_id, r.event_date, r.n_events) for r in events.collect() if r.antigen_norm == "A"]
    assert got == {(p, i): sum(n for q, d, n in held if q == p and s and e and s <= d <= e) for i, (s, e) in enumerate(windows) for p in (1, 2, 3)}
    plan = eligibility.count_in_window(expanded, events)._jdf.queryExecution().executedPlan().toString()
    assert plan[plan.index("SortMergeJoin"):].splitlines()[0].count("window_start") == 0  # no residual range
