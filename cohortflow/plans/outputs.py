"""Publishing several outputs as one: versioned folders, committed by one pointer file.

All outputs are written below ``<base>/versions/<id>/``; then the pointer ``<base>/current.json`` is
replaced by an atomic rename. Readers follow the pointer, so they see the outputs of one complete
run, whatever fails or runs at the same time. The version before is kept for readers that have
already followed the old pointer; older ones are removed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.plans.sizing import Stages, _path

POINTER = "current.json"


def with_dense_id(df: DataFrame, column: str, stages: Stages) -> DataFrame:
    """``df`` with ids 1..n, without a global order: a row's id is its place in its partition plus the
    number of rows in the partitions before. The rows are stored first, so that counts and places
    belong to the same partitions; the running sum has one row a partition."""
    placed = stages.cut(df.withColumn("_place", F.monotonically_increasing_id()))
    part = "shiftright(_place, 33)"
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(F.expr(part).alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
              .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    return (placed.withColumn("_part", F.expr(part)).join(F.broadcast(starts), "_part")  # a row a partition
            .withColumn(column, F.expr("_start + (_place & 8589934591) + 1")).drop("_part", "_place", "_start"))


def current(spark: SparkSession, base: str) -> dict[str, str] | None:
    """Paths of the published outputs by name, or None before the first publication."""
    fs, p = _path(spark, f"{base.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)["paths"]


def publish(spark: SparkSession, base: str, frames: dict[str, DataFrame]) -> dict[str, str]:
    """Write all frames, then commit them together; the paths by name. If a write fails, what was
    published before stays as it is."""
    base = base.rstrip("/")
    version = uuid.uuid4().hex
    paths = {name: f"{base}/versions/{version}/{name}" for name in frames}
    before = current(spark, base)
    fs, versions = _path(spark, f"{base}/versions")
    try:
        for name, df in frames.items():
            df.write.parquet(paths[name])
        fs_, draft = _path(spark, f"{base}/.{version}.json")
        out = fs_.create(draft, True)
        try:
            out.write(bytearray(json.dumps({"version": version, "paths": paths}), "utf-8"))
        finally:
            out.close()
        jvm = spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
        replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        replace[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        files.rename(draft, _path(spark, f"{base}/{POINTER}")[1], replace)
    except BaseException:
        fs.delete(_path(spark, f"{base}/versions/{version}")[1], True)
        raise
    keep = {version, *(path.rsplit("/", 2)[1] for path in (before or {}).values())}
    for status in fs.listStatus(versions):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)
    return paths
