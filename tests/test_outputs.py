"""Publication of several outputs as one, dense ids, stored stages by person."""

import os

import pytest
from pyspark.sql import functions as F

from cohortflow.plans import catalog, outputs
from cohortflow.plans.sizing import Stages

SF_SMALL = "/root/testdata/sf0.001"


def read(spark, base):
    return {name: sorted(r[0] for r in spark.read.parquet(path).collect()) for name, path in outputs.current(spark, base).items()}


def test_readers_see_one_complete_version(spark, tmp_path):
    base = str(tmp_path / "out")
    assert outputs.current(spark, base) is None
    one, two = spark.range(5).toDF("x"), spark.range(10, 13).toDF("x")
    outputs.publish(spark, base, {"a": one, "b": one})
    bad = two.withColumn("x", F.expr("raise_error('lost')"))
    with pytest.raises(Exception, match="lost"):
        outputs.publish(spark, base, {"a": two, "b": bad})  # fails between two writes
    assert read(spark, base) == {"a": [0, 1, 2, 3, 4], "b": [0, 1, 2, 3, 4]}
    assert len(os.listdir(f"{base}/versions")) == 1  # what was written of the failed one is gone
    old = outputs.current(spark, base)
    outputs.publish(spark, base, {"a": two, "b": two})
    assert read(spark, base) == {"a": [10, 11, 12], "b": [10, 11, 12]}
    assert spark.read.parquet(old["a"]).count() == 5  # readers of the pointer before can finish
    outputs.publish(spark, base, {"a": one, "b": two})
    assert read(spark, base) == {"a": [0, 1, 2, 3, 4], "b": [10, 11, 12]}
    assert not os.path.exists(old["a"]) and len(os.listdir(f"{base}/versions")) == 2


@pytest.mark.parametrize("n, parts", [(0, 3), (1, 1), (1000, 37)])
def test_dense_ids_over_many_partitions(spark, n, parts):
    stages = Stages()
    df = spark.range(n).repartition(parts).where("id % 7 != 3")
    got = outputs.with_dense_id(df, "row_id", stages)
    rows = got.collect()
    assert sorted(r.row_id for r in rows) == list(range(1, len(rows) + 1)) and got.columns == ["id", "row_id"]
    assert sorted(r.id for r in rows) == [i for i in range(n) if i % 7 != 3]
    stages.close()


def test_stored_stages_are_joined_by_person_without_exchange(spark):
    p = catalog.pipeline(spark, SF_SMALL)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(p.full_report).count("Exchange hashpartitioning") < 15
    assert plan(p.doses).count("Exchange") == 0
    joined = p.antigens_final.groupBy("person_id").count().join(p.product_status, "person_id").join(p.caveats, "person_id", "left")
    assert plan(joined).count("Exchange") == 0
    assert plan(p.pivots).count("Exchange hashpartitioning") <= 1
    paths = [path for _, path, _ in p.stages.paths]
    assert paths and all(os.path.isdir(path.removeprefix("file:")) for path in paths)
    p.close()
    assert not any(os.path.exists(path.removeprefix("file:")) for path in paths) and not p.stages.paths


def test_large_reference_tables_are_not_broadcast(spark, monkeypatch):
    from cohortflow.plans import sizing
    stages = Stages()
    df = spark.range(100)
    assert "ResolvedHint" in stages.small(df)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 10)
    assert "ResolvedHint" not in stages.small(df)._jdf.queryExecution().analyzed().toString()
    assert Stages(stored=False).small(df) is df
    stages.close()
