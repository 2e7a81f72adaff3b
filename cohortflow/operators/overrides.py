"""Ordered business overrides on antigen rows (D10) and product rows.

Each override is an immutable ``CASE WHEN cond THEN value ELSE col END``
update applied in the documented order; a later override sees what an earlier
one wrote (one ``withColumns`` per statement, all right-hand sides reading the
old values, like a SQL UPDATE).
Per-person inputs (dose-series flags, late 6-in-1, HIB/MenC waiver) are joined
once as one unique-per-person frame; cross-row conditions within a person use
windows over person-partitioned data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions.dates import sql_lit
from cohortflow.operators import text
from cohortflow.operators.dosing import MET_FLAG_SQL


def _in(values) -> str:
    return "(" + ", ".join(sql_lit(v) for v in values) + ")"


def _ci(col: str, value: str) -> F.Column:
    """Case-insensitive equality with a constant."""
    return F.upper(F.col(col)) == value.upper()


# --------------------------------------------------------------------------
# Antigen-level overrides
# --------------------------------------------------------------------------

AM_COLUMNS = ["person_id", "dob", "antigen", "valid_doses_given", "doses_required", "product",
              "stage", "rule_ref", "prev_ref", "met_flag"]


def _ci_sql(col: str, value: str) -> str:
    return f"upper({col}) = {sql_lit(value.upper())}"


def _apply(df: DataFrame, assignments: dict[str, str]) -> DataFrame:
    """One simultaneous update: every right-hand side reads the old values."""
    return df.withColumns({k: F.expr(v) for k, v in assignments.items()})


def menb_override(am: DataFrame) -> DataFrame:
    """A person with an unmet primary MenB row needs 2 doses at the
    12-month MenB stage; then every met flag is recomputed from the counts."""
    menb = _ci_sql("antigen", C.ANTIGEN_MENB)
    primary_unmet = (f"max(CASE WHEN {menb} AND {_ci_sql('stage', C.STAGE_PRIMARY)} AND met_flag = 0 "
                     f"THEN 1 END) OVER (PARTITION BY person_id, antigen)")
    target = f"coalesce({menb} AND {_ci_sql('stage', C.STAGE_12M)} AND {primary_unmet} = 1, FALSE)"
    am = _apply(am, {"doses_required": f"CASE WHEN {target} THEN 2 ELSE doses_required END"})
    return _apply(am, {"met_flag": MET_FLAG_SQL})


def age_waiver(am: DataFrame, policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """Pertussis in the 6-in-1/4-in-1 products is met once more than
    ``pert_waiver_year_diff`` calendar years have passed since birth."""
    hit = (f"coalesce({_ci_sql('antigen', C.ANTIGEN_PERT)} AND product IN {_in(C.PERT_WAIVER_PRODUCTS)} "
           f"AND year({sql_lit(policy.as_of)}) - year(dob) > {policy.pert_waiver_year_diff}, FALSE)")
    return _apply(am, {"met_flag": f"CASE WHEN {hit} THEN 1 ELSE met_flag END",
                       "valid_doses_given": f"CASE WHEN {hit} THEN doses_required ELSE valid_doses_given END"})


def _series_steps(df: DataFrame) -> DataFrame:
    """O6-O9 on a frame carrying ``c_person``, ``valid_dose_count``, ``mmrv_dose_count``.

    O6 'any MMR' product = total valid MMR-containing doses (max 2);
    O7 MMR-1 never exceeds one dose; O8/O9 MMRV-1/-2 reflect combined doses only.
    O6, O8, O9 apply only to people with a dose series row.
    """
    total, combined = "coalesce(valid_dose_count, 0)", "coalesce(mmrv_dose_count, 0)"
    o6 = f"(c_person IS NOT NULL AND product = {sql_lit(C.PRODUCT_MMR_ANY_1)})"
    df = _apply(df, {
        "valid_doses_given": f"CASE WHEN {o6} THEN (CASE WHEN {total} >= 2 THEN 2 WHEN {total} = 1 "
                             f"THEN 1 ELSE 0 END) ELSE valid_doses_given END",
        "met_flag": f"CASE WHEN {o6} THEN (CASE WHEN {total} >= 1 THEN 1 ELSE 0 END) ELSE met_flag END"})
    o7 = f"product = {sql_lit(C.PRODUCT_MMR_1)}"
    df = _apply(df, {
        "valid_doses_given": f"CASE WHEN {o7} AND valid_doses_given > 1 THEN 1 ELSE valid_doses_given END",
        "met_flag": f"CASE WHEN {o7} THEN (CASE WHEN valid_doses_given > 0 THEN 1 ELSE 0 END) "
                    f"ELSE met_flag END"})
    for name, need in ((C.PRODUCT_MMRV_1, 1), (C.PRODUCT_MMRV_2, 2)):
        hit = f"(c_person IS NOT NULL AND product = {sql_lit(name)})"
        val = f"(CASE WHEN {combined} >= {need} THEN 1 ELSE 0 END)"
        df = _apply(df, {"valid_doses_given": f"CASE WHEN {hit} THEN {val} ELSE valid_doses_given END",
                         "met_flag": f"CASE WHEN {hit} THEN {val} ELSE met_flag END"})
    return df.select(*AM_COLUMNS)


def _with_series(am: DataFrame, caveats: DataFrame) -> DataFrame:
    cv = caveats.selectExpr("person_id AS c_person", "valid_dose_count", "mmrv_dose_count")
    return am.join(cv, am.person_id == cv.c_person, "left")


def series_overrides(am: DataFrame, caveats: DataFrame) -> DataFrame:
    """O6-O9 (see :func:`_series_steps`)."""
    return _series_steps(_with_series(am, caveats))


def antigen_overrides(am: DataFrame, caveats: DataFrame,
                      policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """D10 = O3..O9 in order, with one join to the per-person dose series."""
    return _series_steps(_with_series(age_waiver(menb_override(am), policy), caveats))


# --------------------------------------------------------------------------
# Product-level overrides
# --------------------------------------------------------------------------

def event_summary(events_by_product: DataFrame) -> DataFrame:
    """One row per person with all that later stages ask of the product events: the last 6-in-1
    and ACWY dates, and the history text. The event log is read once for them."""
    def last(cond: F.Column) -> F.Column:
        return F.max(F.when(cond, F.col("event_date")))

    return events_by_product.groupBy("person_id").agg(
        last(F.col("vaccine_code") == C.SIX_IN_ONE_CODE).alias("last_6in1"),
        last(_ci("vaccine_desc", C.ACWY_DESCRIPTION)).alias("last_acwy"),
        text.history_list().alias("imms_history"))


def person_flags(am_final: DataFrame, caveats: DataFrame, events: DataFrame,
                 demographics: DataFrame, policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """One row per person with every input the product overrides read.

    * dose-series caveat flags;
    * late_6in1: any 6-in-1 event on/after ``six_in_one_late_age_months``;
    * hib_met / menc_unmet from the antigen rows;
    * acwy_ok: an ACWY event on/after ``acwy_valid_from_weeks`` weeks of the
      demographic date of birth.
    ``events`` is the :func:`event_summary`.
    """
    people = am_final.groupBy("person_id", "dob").agg(
        F.max(F.when(_ci("antigen", C.ANTIGEN_HIB) & (F.col("met_flag") == 1), 1)).alias("hib_met"),
        F.max(F.when(_ci("antigen", C.ANTIGEN_MENC) & (F.col("met_flag") == 0), 1)).alias("menc_unmet"))
    # both dates in one join, so an event summary that is not stored is computed once for them; an ACWY
    # dose that is late enough for any local date of birth is so for the earliest
    last = events.select(F.col("person_id").alias("e_person"), "last_6in1", "last_acwy")
    births = demographics.groupBy(F.col("person_id").alias("d_person")).agg(F.min("dob").alias("dd_dob"))
    p = (people.join(last, people.person_id == last.e_person, "left")
         .withColumn("late_6in1", F.when(F.col("last_6in1") >= F.add_months(
             "dob", policy.six_in_one_late_age_months), 1))
         .groupBy("person_id")
         .agg(F.max("hib_met").alias("hib_met"), F.max("menc_unmet").alias("menc_unmet"),
              F.max("late_6in1").alias("late_6in1"), F.max("last_acwy").alias("last_acwy")))
    cv = caveats.withColumnRenamed("person_id", "c_person")
    return (p.join(births, p.person_id == births.d_person, "left")
            .withColumn("acwy_ok", F.when(F.col("last_acwy") >= F.date_add("dd_dob", 7 * policy.acwy_valid_from_weeks), 1))
            .drop("last_acwy", "d_person", "dd_dob")
            .join(cv, p.person_id == cv.c_person, "left")
            .withColumn("has_caveat", F.col("c_person").isNotNull())
            .drop("c_person"))


PRODUCT_OVERRIDE_GROUPS = ("catchup", "cohort", "late_dose", "cross_product", "mmr_recheck")


def product_steps() -> list[tuple[str, str, dict[str, str]]]:
    """O10..O22 in order: (name, group, assignments) over status rows joined with person flags."""
    cv, unmet = "has_caveat", "coalesce(min_met, 0) = 0"
    mmr12 = _in((C.PRODUCT_MMR_1, C.PRODUCT_MMR_2))
    mmr2 = sql_lit(C.PRODUCT_MMR_2)
    mmrv1, mmrv2 = sql_lit(C.PRODUCT_MMRV_1), sql_lit(C.PRODUCT_MMRV_2)

    def needed_if(cond: str, value: int) -> dict[str, str]:
        return {"still_needed": f"CASE WHEN coalesce({cond}, FALSE) THEN {value} ELSE still_needed END"}

    catch_up = f"{cv} AND catch_up = 1"
    mmr2_needed = (f"max(CASE WHEN product = {mmr2} AND still_needed = 1 THEN 1 END) "
                   f"OVER (PARTITION BY person_id)")
    waived = (f"coalesce(product = {sql_lit(C.PRODUCT_HIBMENC)} AND hib_met = 1 AND acwy_ok = 1 "
              f"AND menc_unmet = 1, FALSE)")
    recheck = (f"coalesce(product IN {mmr12} "
               f"AND coalesce(doses_required, 0) > 0, FALSE)")
    return [
        # catch-up: unmet MMR-1/MMR-2 are no longer needed
        ("O10", "catchup", needed_if(f"{catch_up} AND product IN {mmr12} AND {unmet}", 0)),
        # catch-up, cohort >= 3, first dose not combined: unmet MMRV-1 needed
        ("O11", "catchup", needed_if(f"{catch_up} AND cohort >= 3 AND coalesce(dose1_is_mmrv, 0) = 0 "
                                     f"AND product = {mmrv1} AND {unmet}", 1)),
        # catch-up, < 2 doses and MMR-2 still needed (after O10): MMRV-2 needed
        ("O12", "catchup", needed_if(f"{catch_up} AND valid_dose_count < 2 AND {mmr2_needed} = 1 "
                                     f"AND product = {mmrv2}", 1)),
        # cohort 2 with two combined doses: no further MMRV-2
        ("O13", "cohort", needed_if(f"{cv} AND cohort2_two_mmrv = 1 AND product = {mmrv2}", 0)),
        # cohort 3 invite, then late attender: MMR-2 not needed, MMRV-2 needed
        ("O14", "cohort", needed_if(f"{cv} AND cohort3_invite = 1 AND product = {mmr2}", 0)),
        ("O15", "cohort", needed_if(f"{cv} AND cohort3_invite = 1 AND product = {mmrv2}", 1)),
        ("O16", "cohort", needed_if(f"{cv} AND cohort3_late = 1 AND product = {mmr2}", 0)),
        ("O17", "cohort", needed_if(f"{cv} AND cohort3_late = 1 AND product = {mmrv2}", 1)),
        # cohort 3 with neither action: MMRV-2 not needed
        ("O18", "cohort", needed_if(f"{cv} AND cohort = 3 AND product = {mmrv2} AND "
                                    f"coalesce(cohort3_invite, 0) = 0 AND coalesce(cohort3_late, 0) = 0", 0)),
        # any 6-in-1 dose after 12 months: the 18-month 6-in-1 is not needed
        ("O19", "late_dose", needed_if(f"late_6in1 = 1 AND product = {sql_lit(C.PRODUCT_SIX_IN_ONE_18M)}", 0)),
        # HIB met, valid ACWY given, MenC unmet: HIB/MenC waived and met
        ("O20", "cross_product", {"still_needed": f"CASE WHEN {waived} THEN 0 ELSE still_needed END",
                                  "min_met": f"CASE WHEN {waived} THEN 1 ELSE min_met END"}),
        # MMR-1/MMR-2 met is recomputed from doses given and required
        ("O21/O22", "mmr_recheck", {"min_met": f"CASE WHEN {recheck} THEN (CASE WHEN coalesce(doses_given, 0) "
                                               f">= doses_required THEN 1 ELSE 0 END) ELSE min_met END"}),
    ]


def with_person_facts(status: DataFrame, flags: DataFrame, doses: DataFrame) -> DataFrame:
    """Status rows with their person's flags and the MMR doses, one row for each status row.

    ``flags`` comes from :func:`person_flags`; ``doses`` has ``doses_given`` and ``doses_required``
    per person, product and stage. A product in several stages is rechecked with its fewest given
    and most required doses, so an unmet stage wins and the status rows never multiply.
    """
    f = flags.withColumnRenamed("person_id", "f_person")
    mmr = (C.PRODUCT_MMR_1, C.PRODUCT_MMR_2)
    of = {(agg, c, k): F.expr(f"{agg}(CASE WHEN product = {sql_lit(p)} THEN {c} END)").alias(f"_{c}_{k}")
          for k, p in enumerate(mmr) for agg, c in (("min", "doses_given"), ("max", "doses_required"))}
    # one row a person, so the join is by person alone and needs no exchange of the status rows
    d = doses.where(F.col("product").isin(*mmr)).groupBy(F.col("person_id").alias("d_person")).agg(*of.values())
    own = {c: "CASE product " + " ".join(f"WHEN {sql_lit(p)} THEN _{c}_{k}" for k, p in enumerate(mmr)) + " END"
           for c in ("doses_given", "doses_required")}
    return (status.join(f, status.person_id == f.f_person, "left")
            .join(d, status.person_id == d.d_person, "left").withColumns({c: F.expr(x) for c, x in own.items()}))


def product_overrides(status: DataFrame, flags: DataFrame, doses: DataFrame,
                      groups: tuple[str, ...] = PRODUCT_OVERRIDE_GROUPS) -> DataFrame:
    """D12 = O10..O22 in order on the product status rows.

    ``groups`` selects a prefix of the ordered override groups: catchup (O10-O12), cohort
    (O13-O18), late_dose (O19), cross_product (O20), mmr_recheck (O21-O22). The overrides are
    folded into one expression per target column, each wrapping the previous one, so the whole
    chain is a single projection (plus one person window for O12).
    """
    j = with_person_facts(status, flags, doses)
    for _, group, assignments in product_steps():
        if group in groups:
            j = _apply(j, assignments)
    return j.select("person_id", "product", "stage", "min_met", "still_needed")
