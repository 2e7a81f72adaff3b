"""Product-level status, doses per product and the wide pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions.dates import add_steps_sql, age_steps, sql_lit


def product_all_met(am: DataFrame) -> DataFrame:
    """1 when every antigen row of a (person, product) is met."""
    return am.groupBy("person_id", "product").agg(F.min("met_flag").alias("min_met"))


def product_status(am: DataFrame, rules: DataFrame, policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """Per (person, product, stage, still_needed) the minimum met flag.

    A row is still needed when its rule is inside the due window on ``as_of``
    (from-age reached, to-age not yet reached); a two-dose rotavirus course
    with no dose given is not needed. Rule lookup is an equi-join on the rule id
    against the rule table (bounded by ``Policy.max_rules``) with the window as residual.
    """
    r = F.broadcast(rules.selectExpr("rule_ref AS r_ref", *age_steps("_from", "due_from_value", "due_from_unit"),
                                     *age_steps("_to", "due_to_value", "due_to_unit")))
    a = sql_lit(policy.as_of)
    due = F.expr(f"rule_ref = r_ref AND {a} >= {add_steps_sql('dob', '_from')} AND {a} < {add_steps_sql('dob', '_to')}")
    needed = F.expr(f"CASE WHEN product = {sql_lit(C.PRODUCT_ROTA)} AND valid_doses_given = 0 "
                    f"AND doses_required = 2 THEN 0 WHEN r_ref IS NULL THEN 0 ELSE 1 END")
    return (am.join(r, due, "left")
            .groupBy("person_id", "product", "stage", needed.alias("still_needed"))
            .agg(F.min("met_flag").alias("min_met"))
            .select("person_id", "product", "stage", "min_met", "still_needed"))


def doses_given_required(am: DataFrame) -> DataFrame:
    """Fewest doses given and most doses required per (stage, person, product)."""
    return (am.groupBy("stage", "person_id", "product")
            .agg(F.min("valid_doses_given").alias("doses_given"),
                 F.max("doses_required").alias("doses_required"))
            .drop("stage"))


def tri_state(status: DataFrame) -> DataFrame:
    """0 outstanding, 1 met, 2 not met but not needed."""
    needed, met = F.col("still_needed"), F.col("min_met")
    state = F.when(needed == 1, met).when((needed == 0) & (met == 1), 1).otherwise(2)
    return status.select("person_id", "product", state.alias("state"))


PIVOT_VALUES = ("state", "doses_given", "doses_required")


def pivot_column(product: str, value: str) -> str:
    """Name of a product's column in :func:`pivot_all`."""
    return f"{product}_{value}"


def pivot_all(states: DataFrame, doses: DataFrame, products: list[str]) -> DataFrame:
    """One row per person with three columns for each product (the largest state, doses given
    and doses required), by one aggregate over both inputs.

    The product list is passed explicitly, so Spark needs no extra job to find the pivot values.
    """
    rows = (states.selectExpr("person_id", "product", "state", "CAST(NULL AS INT) AS doses_given", "CAST(NULL AS INT) AS doses_required")
            .union(doses.selectExpr("person_id", "product", "CAST(NULL AS INT) AS state", "doses_given", "doses_required")))
    # dealt by person once: both steps of the pivot stay there, and there is little to combine before
    return (rows.repartition("person_id").groupBy("person_id").pivot("product", products)
            .agg(*[F.max(v).alias(v) for v in PIVOT_VALUES]))


def pivot_part(pivots: DataFrame, value: str, products: list[str]) -> DataFrame:
    """One of the three pivots: one column for each product."""
    return pivots.select("person_id", *[F.col(f"`{pivot_column(p, value)}`").alias(p) for p in products])
