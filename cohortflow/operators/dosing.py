"""Collapse rules to stages and share counted doses between linked stages.

All windows here are keyed by (person, antigen[, product]) and reuse the
partitioning by person, so they add no exchange. Rule-derived sets (take-over
antigens, split products and rules) have at most one row per rule; the pipeline
refuses rule tables above ``Policy.max_rules``, so broadcasting them is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def takeover_antigens(rules: DataFrame) -> DataFrame:
    """Antigens whose later-stage rule starts counting exactly where the earlier
    stage stops counting (same age value and unit)."""
    later = rules.select(F.col("prev_ref").alias("l_prev"), F.col("antigen"),
                         F.col("count_from_value").alias("l_from_v"),
                         F.upper("count_from_unit").alias("l_from_u"))
    earlier = rules.select(F.col("rule_ref").alias("e_ref"),
                           F.col("count_to_value").alias("e_to_v"),
                           F.upper("count_to_unit").alias("e_to_u"))
    return (later.join(earlier, (later.l_prev == earlier.e_ref)
                       & (later.l_from_v == earlier.e_to_v) & (later.l_from_u == earlier.e_to_u))
            .select("antigen").distinct())


def fewest_given(counted: DataFrame) -> DataFrame:
    """The smallest count over all due rules of the same (person, product,
    antigen), as a window minimum (NULL for rows without a rule)."""
    w = Window.partitionBy("person_id", "product", "antigen")
    has_rule = F.col("product").isNotNull() & F.col("antigen").isNotNull()
    return counted.withColumn("given_min", F.when(has_rule, F.min("valid_doses_given").over(w)))


def collapse_stages(counted: DataFrame) -> DataFrame:
    """One row per (person, antigen, product, stage, earlier-stage link).

    The doses given of a product/antigen is the *smallest* count over all of
    its due rules; doses required and rule id are the largest. Rows without a
    rule keep a NULL count.
    """
    return (fewest_given(counted)
            .groupBy("person_id", "dob", "antigen", "product", "stage", "given_min", "prev_ref")
            .agg(F.max(F.col("doses_required").cast("int")).alias("doses_required"),
                 F.max("rule_ref").alias("rule_ref"))
            .withColumnRenamed("given_min", "valid_doses_given")
            .select("person_id", "dob", "antigen", "doses_required", "rule_ref",
                    "valid_doses_given", "product", "stage", "prev_ref"))


def _flag_set(values: DataFrame, key: str, flag: str) -> DataFrame:
    return F.broadcast(values.select(F.col(values.columns[0]).alias(key)).distinct()
                       .withColumn(flag, F.lit(True)))


def allocate_doses(collapsed: DataFrame, rules: DataFrame) -> DataFrame:
    """Share doses between a stage, the later stage that continues it and the
    earlier stage it continues (D6). First matching branch wins.

    g/r = given/required of the row, L = later stage, E = earlier stage:
      1 L and g=0 -> 0
      2 L and r<g and L.r>=L.g and g-L.g>=r -> g-L.g
      3 L and r<=g -> r
      4 E and g=0 -> 0
      5 E and g+E.r<=E.g -> g
      6 E.g<g and antigen not a take-over antigen -> g-E.g
      7 E and E.g<=E.r and product splits doses by stage -> 0
      8 E and rule splits doses by stage -> r
      else g

    L and E are rows of the same person and antigen (L.prev_ref = rule_ref,
    E.rule_ref = prev_ref). Instead of two self-joins -- which would evaluate the
    whole upstream plan three times -- the rows of each (person, antigen) are
    collected once with a window over the partitioning the counting join already
    produced. That group holds at most one row per rule of the antigen, so it is
    bounded by the rule table. Several matching partners give several output
    rows, exactly like the joins.
    """
    split = rules.where(F.col("split_by_stage") == 1)
    takeover = _flag_set(takeover_antigens(rules), "t_antigen", "is_takeover")
    split_products = _flag_set(split.select("product"), "s_product", "is_split_product")
    split_refs = _flag_set(split.select("rule_ref"), "s_ref", "is_split_ref")

    linked = collapsed.withColumn("_rows", F.expr(
        "collect_list(named_struct('rule_ref', rule_ref, 'prev_ref', prev_ref, "
        "'given', valid_doses_given, 'required', doses_required)) "
        "OVER (PARTITION BY person_id, antigen)"))
    with_partners = linked.selectExpr(
        "person_id", "dob", "antigen", "doses_required", "rule_ref", "valid_doses_given",
        "product", "stage", "prev_ref",
        "explode_outer(CASE WHEN antigen IS NOT NULL THEN filter(_rows, x -> x.prev_ref = rule_ref) END) AS l",
        "_rows").selectExpr(
        "*", "explode_outer(CASE WHEN antigen IS NOT NULL THEN filter(_rows, x -> x.rule_ref = prev_ref) END) AS e")
    j = (with_partners
         .join(takeover, F.col("antigen") == takeover.t_antigen, "left")
         .join(split_products, F.col("product") == split_products.s_product, "left")
         .join(split_refs, F.col("rule_ref") == split_refs.s_ref, "left"))
    allocated = F.expr("""CAST(CASE
        WHEN l IS NOT NULL AND valid_doses_given = 0 THEN 0
        WHEN l IS NOT NULL AND doses_required < valid_doses_given AND l.required >= l.given
             AND valid_doses_given - l.given >= doses_required THEN valid_doses_given - l.given
        WHEN l IS NOT NULL AND doses_required <= valid_doses_given THEN doses_required
        WHEN e IS NOT NULL AND valid_doses_given = 0 THEN 0
        WHEN e IS NOT NULL AND valid_doses_given + e.required <= e.given THEN valid_doses_given
        WHEN e.given < valid_doses_given AND NOT coalesce(is_takeover, FALSE)
          THEN valid_doses_given - e.given
        WHEN e IS NOT NULL AND e.given <= e.required AND coalesce(is_split_product, FALSE) THEN 0
        WHEN e IS NOT NULL AND coalesce(is_split_ref, FALSE) THEN doses_required
        ELSE valid_doses_given END AS INT)""")
    return j.select("person_id", "dob", "antigen", allocated.alias("valid_doses_given"),
                    "doses_required", "product", "stage", "rule_ref", "prev_ref")


MET_FLAG_SQL = "CASE WHEN valid_doses_given >= doses_required THEN 1 ELSE 0 END"


def met_flags(allocated: DataFrame) -> DataFrame:
    """Attach the met flag to each allocated row."""
    return allocated.withColumn("met_flag", F.expr(MET_FLAG_SQL))
