"""Registered queries: one per operator of the inventory, each with its oracle.

Every query derives the inputs from the driver tables of ``sf_dir`` (so its
work grows with the data), runs the pipeline up to one stage and returns that
stage's DataFrame. ``ORACLE`` holds the DuckDB SELECT run on top of the CTE
chain of :mod:`cohortflow.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions.dates import add_age
from cohortflow.operators import dosing, overrides, status, text
from cohortflow.plans import oracle as O
from cohortflow.plans.pipeline import ReportPipeline
from cohortflow.sources.fixtures import derive_sources
from cohortflow.sources.schedules import ANY_MMR_SCHEDULE, TEST_SCHEDULE, parse_schedule, schedule_frame

POLICY = C.DEFAULT_POLICY


def schedule_products(schedule: str = TEST_SCHEDULE) -> list[str]:
    """Sorted distinct products of a built-in schedule (same list the pipeline collects)."""
    return sorted({r[4] for r in parse_schedule(schedule)})


def pipeline(spark: SparkSession, sf_dir: str, policy: C.Policy = POLICY, events: bool = True,
             schedule: str = TEST_SCHEDULE) -> ReportPipeline:
    """``events``: whether the product events are read, and so worth being stored once."""
    src = derive_sources(spark, sf_dir, policy.as_of, materialize=events)
    return ReportPipeline(src, schedule_frame(spark, schedule), policy, products=schedule_products(schedule))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, tuple[str, str]] = {}


def register(name: str, select: str, events: bool = True, schedule: str = TEST_SCHEDULE):
    def deco(fn: Callable[[ReportPipeline], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(pipeline(spark, sf_dir, events=events, schedule=schedule))
        ORACLE[name] = (select, schedule)
        return fn
    return deco


def oracle_sql() -> dict[str, str]:
    prefix = {s: O.with_clause(POLICY, schedule_products(s), s) for s in (TEST_SCHEDULE, ANY_MMR_SCHEDULE)}
    return {k: prefix[schedule] + "\n" + select for k, (select, schedule) in ORACLE.items()}


def _cols(*names: str) -> str:
    return ", ".join(O._q(n) for n in names)


PRODUCTS = schedule_products()
STAGE_COLS = [g.column for g in POLICY.gates]
MMR_COLS = [C.PRODUCT_MMR_1, C.PRODUCT_MMRV_1, C.PRODUCT_MMR_2, C.PRODUCT_MMRV_2,
            C.PRODUCT_MMR_ANY_1, C.PRODUCT_MMR_ANY_2]

# --- D1-D7 -------------------------------------------------------------------


@register("rule_age_window", f"""SELECT person_id, rule_ref, window_start, window_end,
  {O.add_age('dob', 'due_from_value', 'due_from_unit')} AS due_from_date,
  {O.add_age('dob', 'due_to_value', 'due_to_unit')} AS due_to_date
FROM temp_pop WHERE rule_ref IS NOT NULL""", events=False)
def _rule_age_window(p: ReportPipeline) -> DataFrame:
    e = p.expanded.where(F.col("rule_ref").isNotNull())
    return e.select("person_id", "rule_ref", "window_start", "window_end",
                    add_age("dob", "due_from_value", "due_from_unit").alias("due_from_date"),
                    add_age("dob", "due_to_value", "due_to_unit").alias("due_to_date"))


@register("clean_events_anti", "SELECT person_id, antigen_code, antigen_dose, event_date, antigen_norm FROM ants")
def _clean(p):
    return p.clean_events.select("person_id", "antigen_code", "antigen_dose", "event_date", "antigen_norm")


@register("expand_rules_theta", "SELECT * FROM temp_pop", events=False)
def _expand(p):
    return p.expanded


@register("count_in_window", "SELECT * FROM antigens_met")
def _count(p):
    return p.counted


@register("takeover_antigens", """SELECT person_id, antigen, rule_ref, valid_doses_given FROM antigens_met
WHERE antigen IN (FROM takeover)""")
def _takeover(p):
    t = dosing.takeover_antigens(p.rules)
    return (p.counted.join(F.broadcast(t), "antigen", "left_semi")  # at most one row per rule
            .select("person_id", "antigen", "rule_ref", "valid_doses_given"))


@register("stage_min_top1", "SELECT person_id, rule_ref, product, antigen, valid_doses_given, given_min FROM top1")
def _top1(p):
    return dosing.fewest_given(p.counted).select("person_id", "rule_ref", "product", "antigen",
                                                 "valid_doses_given", "given_min")


@register("collapse_stages", "SELECT * FROM collapsed")
def _collapse(p):
    return p.collapsed


@register("allocate_doses", "SELECT * FROM allocated")
def _allocate(p):
    return p.allocated


@register("met_flags", "SELECT * FROM am_flags")
def _met(p):
    return p.antigens_met


# --- D8-D10 ------------------------------------------------------------------


@register("cohort_bands", """SELECT c.cohort, c.dob_from, c.dob_to,
  (SELECT count(*) FROM people_cohort pc WHERE pc.cohort = c.cohort) AS n_people
FROM mmrv_cohorts c""", events=False)
def _bands(p):
    n = p.people_cohort.groupBy("cohort").agg(F.count(F.lit(1)).alias("n_people"))
    return (p.bands.join(n, "cohort", "left")
            .select("cohort", "dob_from", "dob_to",
                    F.coalesce("n_people", F.lit(0)).cast("long").alias("n_people")))


@register("band_join", "SELECT * FROM people_cohort", events=False)
def _band_join(p):
    return p.people_cohort


@register("dose_sequence", """SELECT person_id, event_date, is_mmrv, CAST(count(*) AS INTEGER) AS n_doses,
  MAX(dob) AS dob, MAX(cohort) AS cohort,
  CAST(MIN(dose_seq) AS INTEGER) AS seq_from, CAST(MAX(dose_seq) AS INTEGER) AS seq_to
FROM valid_seq GROUP BY person_id, event_date, is_mmrv""")
def _seq(p):
    return p.dose_sequence


SUMMARY_COLS = ["person_id", "cohort", "dose1_is_mmrv", "dose2_is_mmrv", "dose1_date", "dose2_date",
                "mmrv_dose_count", "first_mmrv_date", "valid_dose_count"]
FLAG_COLS = ["person_id", "catch_up", "cohort2_two_mmrv", "cohort3_invite", "cohort3_late"]


@register("series_summary", f"SELECT {_cols(*SUMMARY_COLS)} FROM caveats")
def _summary(p):
    return p.caveats.select(*SUMMARY_COLS)


@register("caveat_flags", f"SELECT {_cols(*FLAG_COLS)} FROM caveats")
def _caveats(p):
    return p.caveats.select(*FLAG_COLS)


@register("menb_override", "SELECT * FROM am_o4")
def _menb(p):
    return overrides.menb_override(p.antigens_met)


@register("age_waiver", "SELECT * FROM am_o5")
def _age_waiver(p):
    return overrides.age_waiver(overrides.menb_override(p.antigens_met), p.policy)


@register("series_overrides", "SELECT * FROM am_final")
def _series_overrides(p):
    return p.antigens_final


@register("any_mmr_override", "SELECT * FROM am_final", schedule=ANY_MMR_SCHEDULE)
def _any_mmr(p):
    """O6 on a schedule that has a product which any MMR-containing dose counts for."""
    return p.antigens_final


# --- D11-D14 -----------------------------------------------------------------


@register("product_all_met", "SELECT * FROM product_all_met")
def _all_met(p):
    return status.product_all_met(p.antigens_final)


@register("product_status", "SELECT * FROM vm_base")
def _status(p):
    return p.status_base


def _overrides_upto(p: ReportPipeline, n: int) -> DataFrame:
    return overrides.product_overrides(p.status_base, p.person_flags, p.doses,
                                       overrides.PRODUCT_OVERRIDE_GROUPS[:n])


@register("catchup_overrides", "SELECT * FROM vm_o12")
def _catchup(p):
    return _overrides_upto(p, 1)


@register("cohort_overrides", "SELECT * FROM vm_o18")
def _cohort(p):
    return _overrides_upto(p, 2)


@register("late_dose_waiver", "SELECT * FROM vm_o19")
def _late(p):
    return _overrides_upto(p, 3)


@register("cross_product_waiver", "SELECT * FROM vm_o20")
def _cross(p):
    return _overrides_upto(p, 4)


@register("mmr_recheck", "SELECT * FROM vm_final")
def _recheck(p):
    return p.product_status


@register("doses_given_required", "SELECT person_id, product, given AS doses_given, required AS doses_required FROM doses")
def _doses(p):
    return p.doses


@register("tri_state", "SELECT * FROM states")
def _tri(p):
    return p.states


@register("pivot_state", "SELECT * FROM pivot_state")
def _pivot_state(p):
    return p.pivot_state


@register("pivot_given", "SELECT * FROM pivot_given")
def _pivot_given(p):
    return p.pivot_given


@register("pivot_required", "SELECT * FROM pivot_required")
def _pivot_required(p):
    return p.pivot_required


# --- D15-D21 -----------------------------------------------------------------


@register("report_core", "SELECT * FROM core")
def _core(p):
    return p.core


@register("demographics_star", "SELECT * FROM master")
def _star(p):
    return p.with_demographics


AGE_COLS = ["person_id", "date_of_birth", "age_in_months", "age_in_years", "full_age", "age_group"]


@register("age_bands", f"SELECT {_cols(*AGE_COLS)} FROM master")
def _ages(p):
    return p.with_demographics.select(*AGE_COLS)


@register("fin_quarter_cover", "SELECT person_id, current_cover, next_quarter_cover FROM master")
def _cover(p):
    return p.with_demographics.select("person_id", "current_cover", "next_quarter_cover")


@register("name_repair", "SELECT person_id, ccg_code, ccg_name FROM master_o25")
def _repair(p):
    return p.repaired.select("person_id", "ccg_code", "ccg_name")


@register("combined_columns", f"SELECT person_id, {_cols(*MMR_COLS)} FROM master_o26")
def _combined(p):
    return p.combined.select("person_id", *[F.col(f"`{c}`") for c in MMR_COLS])


@register("hpv_proxy", f"SELECT person_id, gender, date_of_birth, {_cols(C.PRODUCT_HPV)} FROM master_o28")
def _hpv(p):
    return p.with_hpv.select("person_id", "gender", "date_of_birth", F.col(f"`{C.PRODUCT_HPV}`"))


@register("up_to_date", "SELECT person_id, up_to_date FROM master_flags")
def _utd(p):
    return p.flagged.select("person_id", "up_to_date")


@register("stage_flags", f"SELECT person_id, {_cols(*STAGE_COLS)} FROM master_flags")
def _stage_flags(p):
    return p.flagged.select("person_id", *STAGE_COLS)


@register("negative_consent_text", "SELECT * FROM neg_consent", events=False)
def _neg(p):
    return text.negative_consent_text(p.src.consents)


@register("event_history_text", "SELECT * FROM history")
def _hist(p):
    return text.event_history_text(overrides.event_summary(p.src.events_by_product))  # of all people


@register("non_attendance", "SELECT * FROM dna", events=False)
def _dna(p):
    return text.non_attendance_text(p.src.non_attendance)


@register("suspension_text", "SELECT * FROM susp", events=False)
def _susp(p):
    return text.suspension_text(p.src.suspensions)


@register("outstanding_list", "SELECT person_id, outstanding_imms FROM full_report")
def _outstanding(p):
    return p.full_report.select("person_id", "outstanding_imms")


@register("previous_report_flag", "SELECT person_id, on_previous_report FROM full_report")
def _prev(p):
    return p.full_report.select("person_id", "on_previous_report")


@register("full_report", "SELECT * FROM full_report")
def _full(p):
    return p.full_report


@register("slice_product_compliance", """SELECT person_id, product, MIN(valid_doses_given) AS doses_given,
  MAX(doses_required) AS doses_required,
  MIN(CASE WHEN valid_doses_given >= doses_required THEN 1 ELSE 0 END) AS met
FROM antigens_met WHERE product IS NOT NULL GROUP BY person_id, product""")
def _slice(p):
    return p.slice_product_compliance
