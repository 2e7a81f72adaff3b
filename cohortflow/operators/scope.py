"""Semi-join reduction: leave out rows of people who can't be in the report before they are shuffled.

The ids in scope are hashed into a bit set of a fixed size, kept as rows (word, bits) with 64 bits each.
A row of the log passes if its bit is set; the rows of every id in scope do, and of the others a share
of at most n / (64 x words) does, which the later joins by person leave out as they did before. With
``words`` rows of 16 bytes at most the bit set can be broadcast however many ids there are; where
they are so many that all bits are set, all rows pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _word(key: str, words: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(words).cast("long"))


def _mask(key: str) -> F.Column:
    """The bit of an id: the highest six bits of its hash, as the word takes the low ones."""
    return F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64(`{key}`), 58) AS INT))")


def scope_bits(people: DataFrame, words: int, key: str = "person_id") -> DataFrame:
    """(word, bits) of the ids of ``people``; at most ``words`` rows, put together before they are
    shuffled. Ids that are null are left out; no ids give no rows."""
    rows = people.where(F.col(key).isNotNull()).select(_word(key, words).alias("word"), _mask(key).alias("mask"))
    return rows.groupBy("word").agg(F.bit_or("mask").alias("bits"))


def maybe_in_scope(rows: DataFrame, bits: DataFrame, words: int, key: str = "person_id") -> DataFrame:
    """The rows whose id may be among those that ``bits`` was made of; rows without an id go."""
    hits = F.broadcast(bits.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))  # at most `words` rows
    return (rows.where(F.col(key).isNotNull()).join(hits, _word(key, words) == F.col("_word"))
            .where(F.col("_bits").bitwiseAND(_mask(key)) != 0).select(*rows.columns))
