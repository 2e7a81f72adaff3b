"""Reading rule files as they come: valid rules, rejected lines with reasons, problems of the links.

A line with a bad cell is set aside with every reason that applies, named after the column; the
others are read as `read_rules_csv` reads them. Links between rules are checked on what was read:
rules that continue a rule which is not there, and rules on (or leading into) a circle of links.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.sources.local import local_frame
from cohortflow.sources.schedules import CSV_COLUMNS, RULE_SCHEMA, normalised_rules

UNITS = ("WEEK", "MONTH", "YEAR")
#: Cells that a rule can't do without.
NEEDED = ("rule_ref", "antigen", "doses_required", "product", "stage", "due_from_unit", "due_from_value", "due_to_unit", "due_to_value",
          "count_from_unit", "count_from_value", "count_to_unit", "count_to_value", "valid_from")
DOSE_ORDER = "DoseOrder"


@dataclass(frozen=True)
class RuleFile:
    """``rules`` in the columns of RULE_SCHEMA and ``dose_order``; ``rejects`` with the cells as they
    came and ``reasons``; ``problems`` (rule_ref, problem) of rules that were read."""

    rules: DataFrame
    rejects: DataFrame
    problems: DataFrame


def _parsed(name: str, typ: T.DataType) -> str:
    cell = f"cells.`{name}`"
    if isinstance(typ, T.DateType):
        return f"CAST(try_to_timestamp({cell}, 'dd/MM/yyyy') AS DATE)"
    return f"try_cast({cell} AS {typ.simpleString()})"


def _reasons() -> str:
    """SQL of the list of what is wrong with a line."""
    found = []
    for src, dst in CSV_COLUMNS.items():
        if dst in NEEDED:
            found.append((f"cells.`{src}` IS NULL", f"{src}: missing"))
        if not isinstance(RULE_SCHEMA[dst].dataType, T.StringType):
            found.append((f"cells.`{src}` IS NOT NULL AND parsed.{dst} IS NULL", f"{src}: no {RULE_SCHEMA[dst].dataType.simpleString()}"))
        if dst.endswith("_unit"):
            found.append((f"upper(parsed.{dst}) NOT IN {UNITS}", f"{src}: unknown unit"))
        if dst.endswith("_value") or dst == "doses_required":
            found.append((f"parsed.{dst} < 0", f"{src}: negative"))
    found.append((f"cells.`{DOSE_ORDER}` IS NOT NULL AND parsed.dose_order IS NULL", f"{DOSE_ORDER}: no int"))
    found.append(("parsed.valid_to < parsed.valid_from", "DateValidTo: before DateValidFrom"))
    cases = ", ".join(f"CASE WHEN {cond} THEN '{text}' END" for cond, text in found)
    return f"filter(array({cases}), x -> x IS NOT NULL)"


def link_problems(rules: DataFrame, max_rules: int) -> DataFrame:
    """(rule_ref, problem): repeated ids, links to no rule, and links that run in a circle.

    Circles are found by pointer doubling: after log2(``max_rules``) + 1 rounds, each following twice
    as many links as the one before, only rules that run into a circle still point anywhere.
    """
    spark, rounds = rules.sparkSession, math.ceil(math.log2(max_rules + 1)) + 1

    def held(df: DataFrame, schema: str) -> DataFrame:
        """Rows of a frame with a row a rule at most, as part of the plan."""
        rows = [tuple(r) for r in df.limit(max_rules + 1).collect()]
        return local_frame(spark, rows, schema) if rows else spark.createDataFrame([], schema)

    links = held(rules.select("rule_ref", "prev_ref").where("rule_ref IS NOT NULL"), "rule_ref INT, prev_ref INT").coalesce(1)
    repeated = links.groupBy("rule_ref").count().where("count > 1").select("rule_ref", F.lit("repeated id").alias("problem"))
    known = links.select(F.col("rule_ref").alias("known")).distinct()
    dangling = (links.where("prev_ref IS NOT NULL").join(known, F.col("prev_ref") == F.col("known"), "left_anti")
                .select("rule_ref", F.lit("continues a rule that is not there").alias("problem")).distinct())
    step = links.where("prev_ref IS NOT NULL").groupBy("rule_ref").agg(F.min("prev_ref").alias("to"))
    for _ in range(rounds):
        ahead = step.select(F.col("rule_ref").alias("to"), F.col("to").alias("next"))
        step = held(step.join(ahead, "to").select("rule_ref", "next"), "rule_ref INT, to INT")
    circle = step.select("rule_ref", F.lit("its links run in a circle").alias("problem"))
    return repeated.union(dangling).union(circle)


def read_rules_checked(spark: SparkSession, path: str, max_rules: int = 2_000) -> RuleFile:
    """Read a rule CSV in the published layout; see :class:`RuleFile`. Missing columns count as blank."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    names = [*CSV_COLUMNS, DOSE_ORDER]
    cells = [(f"nullif(trim(`{c}`), '')" if c in raw.columns else "CAST(NULL AS STRING)") + f" AS `{c}`" for c in names]
    lines = raw.selectExpr(*cells).select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("cells"))
    parsed = [f"{_parsed(src, RULE_SCHEMA[dst].dataType)} AS {dst}" for src, dst in CSV_COLUMNS.items()]
    order = _parsed(DOSE_ORDER, T.IntegerType())
    checked = (lines.selectExpr("cells", f"struct({', '.join(parsed)}, {order} AS dose_order) AS parsed")
               .withColumn("reasons", F.expr(_reasons())))
    rules = normalised_rules(checked.where("size(reasons) = 0").select("parsed.*"))
    return RuleFile(rules, checked.where("size(reasons) > 0").select("cells.*", "reasons"), link_problems(rules, max_rules))
