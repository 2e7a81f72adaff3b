"""Connected components of an edge table by alternating star operations.

Every round links the larger neighbours of each node, then all its smaller ones, to the smallest
neighbour; the rounds end when the edges form stars. Degrees may be very uneven: minima are
aggregated before they are shuffled, and they meet the edges in a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm import common as C


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node of ``edges`` (columns u, v) that is not the smallest of its component, and
    that smallest node. Self-links and repeated links do no harm."""
    edges = C.stored(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = C.stored(_small(_large(edges)), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
