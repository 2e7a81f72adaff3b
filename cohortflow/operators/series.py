"""Combined-vaccine cohorts and the per-person MMR-containing dose series.

The dose sequence is computed on events pre-aggregated to one row per
(person, day, is-combined) with a count, so a person with very many records
cannot make one window partition unbounded: the running sum of counts gives
each row its range of sequence numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow import config as C


def cohort_bands(rules: DataFrame, policy: C.Policy = C.DEFAULT_POLICY,
                 products=(C.PRODUCT_MMRV_1, C.PRODUCT_MMRV_2)) -> DataFrame:
    """Distinct date-of-birth validity bands of the combined-vaccine rules, newest
    first, numbered 1..``max_combined_cohorts`` (D8). Runs on the rule table only (a handful of rows)."""
    bands = (rules.where(F.col("product").isin(*products))
             .select(F.col("valid_from").alias("dob_from"), F.col("valid_to").alias("dob_to"))
             .distinct())
    rn = F.row_number().over(Window.orderBy(F.desc("dob_from")))
    return (bands.withColumn("cohort", rn.cast("int"))
            .where(F.col("cohort") <= policy.max_combined_cohorts)
            .select("cohort", "dob_from",
                    F.coalesce("dob_to", F.lit(C.OPEN_END_DATE)).alias("dob_to")))


def band_join(people: DataFrame, bands: DataFrame) -> DataFrame:
    """(person_id, dob) -> cohort by a broadcast range join on the bands."""
    b = F.broadcast(bands)
    return (people.join(b, (people.dob >= b.dob_from) & (people.dob <= b.dob_to), "left")
            .select("person_id", "dob", "cohort"))


def mmr_event_days(events_by_product: DataFrame) -> DataFrame:
    """MMR-containing product events as (person, day, is_combined) -> count."""
    code = F.col("vaccine_code")
    return (events_by_product.where(code.isin(*C.MMR_CONTAINING_CODES))
            .groupBy("person_id", "event_date",
                     F.when(code == C.COMBINED_CODE, 1).otherwise(0).alias("is_mmrv"))
            .agg(F.count(F.lit(1)).alias("n_doses")))


def dose_sequence(people_cohort: DataFrame, event_days: DataFrame,
                  policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """Valid MMR-containing doses (on or after the minimum age) numbered per person
    in date order, combined doses first on the same day (W2).

    One row per (person, day, is_mmrv) with ``n_doses`` and the sequence range
    ``seq_from``..``seq_to`` those doses occupy, plus the max dob/cohort seen.
    """
    ev = event_days.withColumnRenamed("person_id", "e_person")
    j = (people_cohort.join(ev, people_cohort.person_id == ev.e_person)
         .where(F.col("event_date") >= F.add_months("dob", policy.mmr_valid_from_age_months)))
    days = (j.groupBy("person_id", "event_date", "is_mmrv")
            .agg(F.sum("n_doses").cast("int").alias("n_doses"), F.max("dob").alias("dob"),
                 F.max("cohort").alias("cohort")))
    w = (Window.partitionBy("person_id").orderBy("event_date", F.desc("is_mmrv"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seq_to = F.sum("n_doses").over(w).cast("int")
    return (days.withColumn("seq_to", seq_to)
            .withColumn("seq_from", (F.col("seq_to") - F.col("n_doses") + 1).cast("int")))


def series_summary(sequence: DataFrame, policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """Per person: valid MMR-containing doses, combined doses, first/second dose
    date and type, and the four combined-vaccine caveat flags (D9)."""
    def at(k: int, c: str) -> F.Column:
        hit = (F.col("seq_from") <= k) & (F.col("seq_to") >= k)
        return F.max(F.when(hit, F.col(c)))

    s = (sequence.groupBy("person_id")
         .agg(F.max("dob").alias("dob"), F.max("cohort").alias("cohort"),
              F.sum("n_doses").cast("int").alias("valid_dose_count"),
              F.sum(F.when(F.col("is_mmrv") == 1, F.col("n_doses")).otherwise(0)).cast("int")
              .alias("mmrv_dose_count"),
              F.min(F.when(F.col("is_mmrv") == 1, F.col("event_date"))).alias("first_mmrv_date"),
              at(1, "event_date").alias("dose1_date"), at(1, "is_mmrv").alias("dose1_is_mmrv"),
              at(2, "event_date").alias("dose2_date"), at(2, "is_mmrv").alias("dose2_is_mmrv")))
    return caveat_flags(s, policy)


def caveat_flags(summary: DataFrame, policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """Derive the catch-up and cohort 2/3 flags from a per-person dose summary."""
    as_of = F.lit(policy.as_of)
    cohort, n = F.col("cohort"), F.coalesce(F.col("valid_dose_count"), F.lit(0))
    d1, d2 = F.col("dose1_is_mmrv"), F.col("dose2_is_mmrv")
    late_age = F.add_months("dob", policy.late_second_dose_age_months)

    def flag(cond: F.Column) -> F.Column:
        return F.when(cond, 1).otherwise(0)

    return summary.select(
        "person_id", "cohort",
        F.coalesce(d1, F.lit(0)).alias("dose1_is_mmrv"),
        F.coalesce(d2, F.lit(0)).alias("dose2_is_mmrv"),
        "dose1_date", "dose2_date",
        F.coalesce("mmrv_dose_count", F.lit(0)).alias("mmrv_dose_count"),
        "first_mmrv_date",
        n.alias("valid_dose_count"),
        flag((as_of >= F.lit(policy.catch_up_from)) & cohort.isin(1, 2, 3) & (n < 2))
        .alias("catch_up"),
        flag((cohort == 2) & (n >= 2) & (d1 == 1) & (d2 == 1)).alias("cohort2_two_mmrv"),
        flag((cohort == 3) & (n == 1) & (d1 == 1) & (as_of >= late_age)).alias("cohort3_invite"),
        flag((cohort == 3) & (n == 1) & (d1 == 1) & (F.col("dose1_date") < late_age))
        .alias("cohort3_late"),
    )
