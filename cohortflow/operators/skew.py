"""Lookups in a large reference table under hot keys, without reliance on adaptive splitting.

A key that more than one row in ``SHARE`` has is hot; there are fewer than ``SHARE`` of them, so they can
be broadcast whatever the data are. The rows of a hot key are dealt to ``SALTS`` tasks by another
column, and the reference row of that key goes to each of them; all other keys move once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE, SALTS = 64, 64


def hot_keys(rows: DataFrame, key: str, share: int = SHARE) -> DataFrame:
    """(hot) the keys that more than one in ``share`` of the rows has: an exact count, put together
    before it is shuffled. Null is no key."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    every = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col(key).isNotNull() & (F.col("_n") * share > every)).select(F.col(key).alias("hot"))


def salted_left_join(rows: DataFrame, table: DataFrame, key: F.Column, table_key: str, hot: DataFrame,
                     deal_by: str, salts: int = SALTS) -> DataFrame:
    """``rows`` left-joined to ``table`` (one row a key) on ``key`` = ``table_key``, with the rows of
    ``hot`` keys dealt by ``deal_by``. All columns of both; rows that match nothing keep nulls."""
    mine, theirs = (F.broadcast(hot.select(F.col("hot").alias(c))) for c in ("_hot", "_hot_key"))  # fewer than SHARE rows
    left = (rows.withColumn("_key", key).join(mine, F.col("_key") == F.col("_hot"), "left")
            .withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(deal_by), F.lit(salts)).cast("int")).otherwise(0)))
    each = F.when(F.col("_hot_key").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    # dealt by both columns: a partitioning by the key alone would satisfy the join and undo the salt
    right = (table.join(theirs, F.col(table_key) == F.col("_hot_key"), "left").withColumn("_part", F.explode(each))
             .repartition(table_key, "_part"))
    return (left.join(right, (F.col("_key") == F.col(table_key)) & (F.col("_salt") == F.col("_part")), "left")
            .select(*[rows[c] for c in rows.columns], *[right[c] for c in table.columns]))
