"""Up-to-date status flags per person, overall and per stage (D18: O29-O34).

All membership tests ('has an outstanding product', 'has a row for this
stage', 'has any antigen record') become one per-person aggregate that is
left-joined once; no NOT IN subquery (which would broadcast its whole right
side) is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions.dates import sql_lit


def _slug(stage: str) -> str:
    return stage.lower().replace(" ", "_")


def stage_summary(status: DataFrame, stages: list[str]) -> DataFrame:
    """Per person: any outstanding product, and per stage outstanding / present."""
    out = "(min_met = 0 AND still_needed = 1)"
    aggs = [F.expr(f"max(CASE WHEN {out} THEN 1 ELSE 0 END)").alias("any_outstanding")]
    for s in stages:
        st = f"upper(stage) = {sql_lit(s.upper())}"
        aggs.append(F.expr(f"max(CASE WHEN {out} AND {st} THEN 1 ELSE 0 END)").alias(f"out__{_slug(s)}"))
        aggs.append(F.expr(f"max(CASE WHEN {st} THEN 1 ELSE 0 END)").alias(f"has__{_slug(s)}"))
    return status.groupBy("person_id").agg(*aggs)


def up_to_date(report: DataFrame, status: DataFrame, events_by_antigen: DataFrame,
               policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """O29-O34.

    Overall: 'No Record' without any antigen event, else 'No' with any
    outstanding product (state 0 and still needed), else 'Yes'.
    Per stage: 'No' with an outstanding product of the stage, 'Yes' with a row
    for the stage and none outstanding, else NULL; people with 'No Record'
    overall get 'No Record' for a stage when the stage gate allows it.
    """
    stages = [g.stage for g in policy.gates]
    summ = stage_summary(status, stages).withColumnRenamed("person_id", "s_person")
    recorded = events_by_antigen.selectExpr("person_id AS r_person").distinct()
    j = (report.join(summ, report.person_id == summ.s_person, "left")
         .join(recorded, report.person_id == recorded.r_person, "left"))
    no_rec, no, yes = sql_lit(C.NO_RECORD), sql_lit(C.NO), sql_lit(C.YES)
    overall = f"CASE WHEN r_person IS NULL THEN {no_rec} WHEN any_outstanding = 1 THEN {no} ELSE {yes} END"
    cols = {"up_to_date": F.expr(overall)}
    for g in policy.gates:
        slug = _slug(g.stage)
        v = f"(CASE WHEN out__{slug} = 1 THEN {no} WHEN has__{slug} = 1 THEN {yes} END)"
        gate = _gate(g, v, policy, set(report.columns))
        cols[g.column] = F.expr(f"CASE WHEN r_person IS NULL AND coalesce({gate}, FALSE) "
                                f"THEN {no_rec} ELSE {v} END")
    helpers = ["s_person", "r_person", "any_outstanding"] + \
        [f"{k}__{_slug(s)}" for s in stages for k in ("out", "has")]
    return j.withColumns(cols).drop(*helpers)


def _gate(g: C.StageGate, value: str, policy: C.Policy, columns: set[str]) -> str:
    if g.always:
        return "TRUE"
    if g.min_age_months is not None:
        cond = f"(age_in_months >= {g.min_age_months} OR {value} IS NOT NULL)"
    else:
        cond = f"(age_in_years >= {g.min_age_years} OR {value} IS NOT NULL)"
    if g.stage == C.STAGE_18M:
        # A product missing from the schedule has no report column: its cell is NULL.
        present = " OR ".join(f"`{p}` IS NOT NULL" for p in policy.stage18_products if p in columns)
        cond = (f"{cond} AND {sql_lit(policy.as_of)} > {sql_lit(policy.stage18_report_after)} "
                f"AND date_of_birth >= {sql_lit(policy.stage18_born_from)} AND ({present or 'FALSE'})")
    return cond
