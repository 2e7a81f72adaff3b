"""Event days, their running counts and the counting join stay dealt by person."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.operators import eligibility
from cohortflow.plans.sizing import Stages
from cohortflow.sources.schedules import schedule_frame

DAY, BASE = dt.timedelta(days=1), dt.date(2020, 1, 1)
ANTIGENS = "person_id long, antigen_code string, antigen_dose string, event_date date"
PRODUCTS = "person_id long, vaccine_code string, vaccine_part string, vaccine_desc string, event_date date"
EXPANDED = ("person_id long, dob date, rule_ref int, prev_ref int, antigen string, product string, stage string, "
            "doses_required int, va_date date, window_start date, window_end date")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def all_keys(spark):
    """A session that wants all join keys in a partitioning, as Spark does by default."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    yield
    spark.conf.set(name, before)


def test_counting_join_deals_nothing_by_antigen(spark, all_keys):
    people = spark.createDataFrame([(i, BASE, C.DEFAULT_POLICY.as_of) for i in range(20)], "person_id long, dob date, va_date date")
    ba = spark.createDataFrame([(i, "DIPH", "1P", BASE + 60 * DAY) for i in range(20)], ANTIGENS)
    expanded = eligibility.expand_rules(people, schedule_frame(spark), C.DEFAULT_POLICY.as_of)
    counts = eligibility.event_counts(eligibility.clean_event_days(ba, spark.createDataFrame([], PRODUCTS)))
    assert not re.search(r"hashpartitioning\([^)]*antigen(_norm)?#", _plan(eligibility.count_in_window(expanded, counts)))


def test_stored_events_are_reduced_where_they_are(spark, small_pipeline):
    assert "Exchange hashpartitioning" not in _plan(small_pipeline.event_counts)


def test_rows_of_one_day_are_one_entry(spark):
    rows = [(1, "A", BASE, 2), (1, "A", BASE, 3), (1, "A", BASE + DAY, 1), (1, "B", BASE, 4), (1, "A", None, 9), (2, None, BASE, 5), (2, None, BASE, 1)]
    counts = spark.createDataFrame(rows, "person_id long, antigen_norm string, event_date date, n_events long")
    got = {(r.person_id, r.antigen_norm): ([tuple(d) for d in r.days], r.steps) for r in eligibility.running_counts(counts).collect()}
    assert got == {(1, "A"): ([(BASE, 5), (BASE + DAY, 6)], [2, 1]), (1, "B"): ([(BASE, 4)], [1]), (2, None): ([(BASE, 6)], [1])}


def test_counts_of_repeated_days_codes_and_doses(spark, all_keys):
    rng = random.Random(7)
    raw = [(p, rng.choice(["MENW", "ACWY", "HPV", None]), rng.choice(["1P", "2P", "1B", None]), rng.choice([None, *(BASE + k * DAY for k in range(6))])) for p in (1, 2, None) for _ in range(150)]
    days = eligibility.clean_event_days(spark.createDataFrame(raw, ANTIGENS), spark.createDataFrame([], PRODUCTS))
    ends = [None, *(BASE + k * DAY for k in range(-1, 8))]
    rules = [(p, BASE, i, None, a, "P", "S", 1, None, rng.choice(ends), rng.choice(ends)) for i in range(60) for p in (1, 2, 3) for a in ("ACWY", "HPV", "X", None)]
    out = eligibility.count_in_window(spark.createDataFrame(rules, EXPANDED), eligibility.event_counts(days)).collect()
    names = {"MENW": "ACWY"}
    want = {(p, i, a): sum(q == p and c is not None and names.get(c, c) == a and d is not None and s <= d <= e for q, c, _, d in raw) if s and e else 0
            for p, _, i, _, a, *_, s, e in rules}
    assert len(out) == len(rules) and {(r.person_id, r.rule_ref, r.antigen): r.valid_doses_given for r in out} == want


def test_rows_stored_as_dealt_are_all_there(spark):
    """Also if they were not dealt by that column after all."""
    rows = spark.range(500).select((F.col("id") % 37).alias("k"), "id").repartition(5, "id")
    stages = Stages()
    stored = stages.cut(rows, "k", dealt=True)
    got = {r.k: (r.n, r.s) for r in stored.groupBy("k").agg(F.count("id").alias("n"), F.sum("id").alias("s")).collect()}
    assert got == {k: (len(range(k, 500, 37)), sum(range(k, 500, 37))) for k in range(37)}
    stages.close()
