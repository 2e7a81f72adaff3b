"""The filter by people in scope: no row of theirs is lost, others go before the first shuffle."""

import dataclasses
import re

from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.operators import eligibility
from cohortflow.operators.scope import maybe_in_scope, scope_bits
from cohortflow.plans import catalog
from cohortflow.plans.pipeline import ReportPipeline
from cohortflow.sources.fixtures import derive_sources
from cohortflow.sources.schedules import schedule_frame

SF_SMALL = "/root/testdata/sf0.001"


def _pipeline(spark, **changes):
    policy = dataclasses.replace(C.DEFAULT_POLICY, **changes)
    src = derive_sources(spark, SF_SMALL, policy.as_of, materialize=False)
    return ReportPipeline(src, schedule_frame(spark), policy, products=catalog.schedule_products(), materialize=False)


def test_people_in_scope_keep_all_rows_and_a_tenth_of_the_rows_is_left(spark):
    rows = spark.range(200_000).selectExpr("CAST(id % 20000 - 10000 AS long) AS person_id", "id AS event")
    rows = rows.union(spark.sql("SELECT CAST(NULL AS long), -1L"))
    people = spark.range(2_000).selectExpr("CAST(id * 10 - 10000 AS long) AS person_id").union(spark.sql("SELECT CAST(NULL AS long)"))
    for words, most in ((1 << 14, 20_000 + 1.5 * 180_000 * 2_000 / (64 << 14)), (1, 200_000)):  # 343 by chance expected
        kept = maybe_in_scope(rows, scope_bits(people, words), words)
        assert kept.columns == rows.columns
        n, mine = kept.agg(F.count("*"), F.count(F.when(F.col("person_id") % 10 == 0, 1))).first()
        assert mine == 20_000 <= n <= most
    assert scope_bits(people, 8).count() == 8
    assert maybe_in_scope(rows, scope_bits(people.limit(0), 8), 8).count() == 0


def test_text_ids_and_every_bit(spark):
    rows = spark.range(5000).selectExpr("concat('p', id) AS person_id", "1 AS word", "2 AS bits")
    kept = maybe_in_scope(rows, scope_bits(rows, 64), 64)
    assert kept.count() == 5000 and kept.columns == rows.columns
    assert scope_bits(rows, 2).where("bits = -1").count() == 2  # 2,500 ids a word: full, the sign bit too


def test_events_are_filtered_before_the_first_exchange(spark):
    """On logs that no one has dealt out yet (those of the fixtures are dealt by person already)."""
    log = spark.range(10).selectExpr("id AS person_id", "'DIPH' AS antigen_code", "'1P' AS antigen_dose", "DATE'2020-01-01' AS event_date",
                                     "'4IN1' AS vaccine_code", "'B' AS vaccine_part")
    bits = scope_bits(spark.range(3).withColumnRenamed("id", "person_id"), 64)
    scoped = maybe_in_scope(log, bits, 64)
    plan = eligibility.clean_event_days(scoped, scoped, C.DEFAULT_POLICY)._jdf.queryExecution().executedPlan().toString()
    joins = [m.start() for m in re.finditer(r"BroadcastHashJoin \[pmod\(xxhash64\((?:person_id|id)#", plan)]
    assert len(joins) == 2  # one for each log
    for at in joins:
        below = plan[:at].rindex("Exchange hashpartitioning")
        assert "Aggregate" in plan[below:at] and "Exchange hashpartitioning(word" in plan[at:]
    assert "CartesianProduct" not in plan


def test_results_are_the_same_without_the_filter(spark):
    got = [sorted(map(tuple, df.collect()), key=repr) for scope_filter_words in (0, 1 << 4, 1 << 20)
           for p in [_pipeline(spark, scope_filter_words=scope_filter_words, min_population_age_months=240)]
           for df in (p.counted.select("person_id", "rule_ref", "valid_doses_given"),)]
    assert got[0] == got[1] == got[2] and len(got[0]) > 100
