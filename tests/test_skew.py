"""Lookups under hot keys with adaptive execution off: same rows, dealt to many tasks."""

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import report
from cohortflow.operators.skew import hot_keys, salted_left_join
from cohortflow.plans import catalog, sizing

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def plain(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _people(spark):
    """A third of 30,000 people have practice P0, a third none, the others one of 5,000."""
    code = "CASE WHEN id % 3 = 0 THEN 'P0' WHEN id % 3 = 1 THEN concat('P', id % 5000) END"
    return spark.range(30_000).selectExpr("id AS person_id", f"{code} AS code")


def test_hot_keys(plain):
    people = _people(plain)
    assert [r.hot for r in hot_keys(people, "code").collect()] == ["P0"]
    assert hot_keys(people, "code", share=2).count() == 0
    assert hot_keys(people.limit(0), "code").count() == 0
    assert hot_keys(people, "code", share=3).count() == 1  # 10,002 of 30,000: more than a third


def test_same_rows_in_many_tasks(plain):
    people = _people(plain)
    table = plain.range(4000).selectExpr("concat('P', id) AS t_code", "id AS t_value").repartition("t_code")
    joined = salted_left_join(people, table, F.col("code"), "t_code", hot_keys(people, "code"), "person_id")
    assert joined.columns == ["person_id", "code", "t_code", "t_value"]
    expected = people.join(table, F.col("code") == F.col("t_code"), "left")
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    tasks = joined.where("code = 'P0'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) >= 12 and max(r["count"] for r in tasks) < 3_000
    assert salted_left_join(people, table.limit(0), F.col("code"), "t_code", hot_keys(people, "code"), "person_id").where("t_code IS NULL").count() == 30_000


def test_star_with_large_reference_tables(spark, monkeypatch):
    small = catalog.pipeline(spark, SF_SMALL)
    assert small.hot_codes == {}  # read before the limit is changed
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    large = catalog.pipeline(spark, SF_SMALL)
    stars = []
    for p in (small, large):
        core = p.people.select("person_id")
        s, d = p.src, p.dimensions
        stars.append(report.demographics_star(core, s.population, s.demographics, d["gp"], d["la"], d["postcodes"], d["deprivation"],
                                              d["schools"], p.policy, unique=True, hot=p.hot_codes))
    assert len(large.hot_codes) == 7
    assert sorted(map(tuple, stars[0].collect()), key=repr) == sorted(map(tuple, stars[1].collect()), key=repr)
    small.close()
    large.close()
