"""A training-corpus pipeline of five stages over the documents table.

Each stage takes the documents that its predecessor kept, as written to Parquet, and returns the
columns of documents; the last one returns packed pieces. Rows carry all their columns along.

* quality rules: documents that the rules reject go.
* near duplicates: of each group the document with the smallest id stays; a repeated row stays once.
* substrings: word sequences that a document with a smaller id has too are cut out of the text; a
  text that loses nothing stays as it is, also in its white space.
* personal data: every span found is replaced by its kind.
* packing: what is left is tokenised and packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm import common, minhash, packing, pii, quality, substrings

#: No SQL: suffix arrays, tokenisers and packing; tests compare `run` with a brute-force version.
ORACLE_SQL = None


def _carried(docs: DataFrame) -> DataFrame:
    """Id, text and the whole row, so that no column of a result clashes with one of documents."""
    return docs.select("doc_id", "text", F.struct("*").alias("row"))


def _with_text(rows: DataFrame, columns: list[str], text: F.Column, changed: F.Column) -> DataFrame:
    new = rows.withColumn("new_text", F.when(changed, text).otherwise(F.col("row.text"))).withColumn("changed", changed)
    size = F.when(F.col("changed"), F.length("new_text")).otherwise(F.col("row.n_chars")).cast("long") if "n_chars" in columns else None
    value = {"text": F.col("new_text"), "n_chars": size}
    return new.select(*[(value[c] if c in value else F.col("row")[c]).alias(c) for c in columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_carried(docs)).where("kept").select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = minhash.near_duplicates(docs).where("kept")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name")
    rows = docs.select(name, F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"))
    return rows.join(kept.select(name, "text_hash"), ["name", "text_hash"], "left_semi").dropDuplicates(["name", "text_hash"]).select("row.*")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.substring_dedup(_carried(docs))
    return _with_text(cut, docs.columns, F.col("kept_text"), F.col("n_removed") > 0)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.pii_mask(_carried(docs))
    return _with_text(masked, docs.columns, F.col("masked_text"), ~F.col("masked_text").eqNullSafe(F.col("text")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(docs, public_tokenizers.path(packing.VOCABULARY))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
