"""Work for each row stays small: what rules fix is computed for the rule, and generated methods stay compilable."""

import datetime as dt
import re

from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions import dates as D
from cohortflow.operators import eligibility, report, status
from cohortflow.operators.status import pivot_column
from cohortflow.sources.schedules import schedule_frame

JIT_LIMIT = 8000  # bytes of a method; the JVM never compiles a larger one


def _largest_method(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        text = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))


def _pivots(spark, products):
    """Three people: given and state of product i depend on person and i, with nulls among them."""
    def value(k):
        return [f"CASE WHEN (id + {i} + {k}) % 3 > 0 THEN CAST((id * {i} + {k}) % 5 AS INT) END AS `{pivot_column(p, v)}`"
                for i, p in enumerate(products) for v in [("doses_given", "state")[k]]]
    return spark.range(3).selectExpr("id AS person_id", *value(0), *value(1))


def test_cells_of_many_products_make_a_small_method(spark):
    products = [f"P {i}" for i in range(40)]
    core = report.report_core(_pivots(spark, products).localCheckpoint(), products)
    assert _largest_method(spark, core) < JIT_LIMIT
    assert core.columns == ["person_id", *products]

    def cell(i, person):
        g, s = ((person * i + k) % 5 if (person + i + k) % 3 else None for k in (0, 1))
        return None if g is None and s is None else f"{'' if g is None else g}.{'' if s is None else s}"
    assert sorted(map(tuple, core.collect())) == [(n, *[cell(i, n) for i in range(40)]) for n in range(3)]


def test_report_core_of_the_fixtures(spark, small_pipeline):
    assert _largest_method(spark, small_pipeline.core) < JIT_LIMIT


def test_steps_are_the_same_age(spark):
    days = [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2023, 12, 31), dt.date(2000, 3, 1), None]
    ages = [(v, u) for v in (None, 0, 1, 7, 13, 48, -2) for u in ("Week", "month ", " YEAR", "Day", "", None)]
    df = spark.createDataFrame([(d, v, u) for d in days for v, u in ages], "d date, v int, u string")
    steps = df.selectExpr("d", "v", "u", *D.age_steps("age", "v", "u"))
    both = steps.select(D.add_age("d", "v", "u").alias("a"), F.expr(D.add_steps_sql("d", "age")).alias("b"))
    assert both.where("NOT a <=> b").isEmpty() and both.where("b IS NOT NULL").count() == 4 * 6 * 3


def test_units_are_read_for_the_rules_alone(spark):
    rules = schedule_frame(spark)
    people = spark.range(5).selectExpr("id AS person_id", "DATE'2020-01-01' AS dob", "DATE'2027-02-15' AS va_date").localCheckpoint()
    am = spark.range(5).selectExpr("id AS person_id", "DATE'2020-01-01' AS dob", "'P' AS product", "'S' AS stage", "1 AS rule_ref",
                                   "1 AS valid_doses_given", "1 AS doses_required", "1 AS met_flag").localCheckpoint()
    for df in (eligibility.expand_rules(people, rules, C.DEFAULT_POLICY.as_of), status.product_status(am, rules)):
        lines = [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "add_months(dob" in x]
        assert lines and not any("upper(" in x for x in lines)
