"""Composition of the operators into the full compliance report.

``ReportPipeline`` exposes every intermediate stage as a lazily built, cached
DataFrame, so a caller (or a registered query) can stop at any stage. Stages
that several later ones read - the per-person dose series, the final antigen rows
and the final product status - and the history texts are stored in the session's
shared checkpoint folder as tables bucketed by person: a lost executor
costs no recomputation of what came before, and what joins or groups them by
person needs no exchange. Reference tables are stored too, and broadcast if
their stored size allows. ``close()`` removes all of them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.operators import dosing, eligibility, flags, overrides, report, scope, series, skew, status, text
from cohortflow.plans.outputs import publish, with_dense_id
from cohortflow.plans.sizing import Stages, checked_rules
from cohortflow.sources.schedules import normalised_rules
from cohortflow.sources.tables import Sources


class ReportPipeline:
    def __init__(self, sources: Sources, rules: DataFrame, policy: C.Policy = C.DEFAULT_POLICY,
                 products: list[str] | None = None, materialize: bool = True):
        self.src = sources.cleaned()
        self.rules = checked_rules(normalised_rules(rules), policy.max_rules)
        self.policy = policy
        self._products = products
        self.stages = Stages(stored=materialize)

    def _cut(self, df: DataFrame, dealt: bool = False) -> DataFrame:
        return self.stages.cut(df, "person_id", dealt)

    def close(self) -> None:
        """Remove the stored stages; the pipeline's frames can't be read any more."""
        self.stages.close()

    @cached_property
    def dimensions(self) -> dict[str, DataFrame]:
        """The reference tables, one row a key."""
        s = self.src
        return {name: self.stages.small(report.dedupe_on(df, key)) for name, df, key in (
            ("gp", s.gp, "practice_code"), ("la", s.la, "la_code"), ("postcodes", s.postcodes, "postcode"),
            ("deprivation", s.deprivation, "lsoa"), ("schools", s.schools, "school_code"), ("ccg", s.ccg, "ccg_code"))}

    @cached_property
    def hot_codes(self) -> dict[str, DataFrame]:
        """The hot keys of each person column that looks up a reference table too large to broadcast."""
        pop, local, d = self.src.population, self.src.demographics, self.dimensions
        columns = (("gp", "pd_gp_code", pop), ("gp", "dd_practice_code", local), ("la", "pd_la_code", pop),
                   ("la", "dd_la_code", local), ("postcodes", "pd_postcode", pop), ("postcodes", "dd_postcode", local),
                   ("schools", "dd_school_code", local))
        return {key: skew.hot_keys(people, key[3:]) for name, key, people in columns if self.stages.is_large(d[name])}

    # -- metadata ------------------------------------------------------------
    @cached_property
    def products(self) -> list[str]:
        """Sorted distinct products of the rule table: the report's dynamic columns.

        It reads the rule table, whose size was checked in the constructor.
        """
        if self._products is not None:
            return list(self._products)
        rows = (self.rules.where(F.col("product").isNotNull()).select("product").distinct()
                .orderBy("product").collect())
        return [r.product for r in rows]

    # -- people in scope -----------------------------------------------------
    @cached_property
    def scope_bits(self) -> DataFrame:
        """Bit set of the people in scope, stored once for all that read the event logs."""
        words = self.policy.scope_filter_words
        return self.stages.cut(scope.scope_bits(self.in_scope, words))

    @cached_property
    def in_scope(self) -> DataFrame:
        return eligibility.in_scope_people(self.src.population, self.policy.as_of, self.policy)

    def _scoped(self, events: DataFrame) -> DataFrame:
        words = self.policy.scope_filter_words
        return scope.maybe_in_scope(events, self.scope_bits, words) if words else events

    @cached_property
    def scoped_antigens(self) -> DataFrame:
        """Antigen events without (nearly all of) those of people out of scope, before any shuffle."""
        return self._scoped(self.src.events_by_antigen)

    @cached_property
    def scoped_products(self) -> DataFrame:
        return self._scoped(self.src.events_by_product)

    # -- D1-D7 ---------------------------------------------------------------
    @cached_property
    def event_days(self) -> DataFrame:
        return eligibility.clean_event_days(self.src.events_by_antigen, self.src.events_by_product,
                                            self.policy)

    @cached_property
    def clean_events(self) -> DataFrame:
        return eligibility.clean_events(self.event_days)

    @cached_property
    def event_counts(self) -> DataFrame:
        """Day counts of the people in scope (``clean_events`` has those of all people)."""
        return eligibility.event_counts(eligibility.clean_event_days(
            self.scoped_antigens, self.scoped_products, self.policy, combine=not self.src.by_person))

    @cached_property
    def expanded(self) -> DataFrame:
        return eligibility.expand_rules(self.src.population, self.rules, self.policy.as_of,
                                        self.policy)

    @cached_property
    def counted(self) -> DataFrame:
        return eligibility.count_in_window(self.expanded, self.event_counts, eligibility.has_alike_rules(self.rules))

    @cached_property
    def collapsed(self) -> DataFrame:
        return dosing.collapse_stages(self.counted)

    @cached_property
    def allocated(self) -> DataFrame:
        return dosing.allocate_doses(self.collapsed, self.rules)

    @cached_property
    def antigens_met(self) -> DataFrame:
        return dosing.met_flags(self.allocated)

    # -- D8-D10 --------------------------------------------------------------
    @cached_property
    def people(self) -> DataFrame:
        """Distinct (person, dob) of the expanded population.

        Taken from the in-scope population rather than from the allocated rows
        (the same set: every step after the expansion is a left join or keeps
        each person), so the dose series does not re-run the allocation chain.
        """
        return self.in_scope.select("person_id", "dob").distinct()

    @cached_property
    def bands(self) -> DataFrame:
        return series.cohort_bands(self.rules, self.policy)

    @cached_property
    def people_cohort(self) -> DataFrame:
        return series.band_join(self.people, self.bands)

    @cached_property
    def dose_sequence(self) -> DataFrame:
        return series.dose_sequence(self.people_cohort,
                                    series.mmr_event_days(self.scoped_products), self.policy)

    @cached_property
    def caveats(self) -> DataFrame:
        return self._cut(series.series_summary(self.dose_sequence, self.policy))

    @cached_property
    def event_summary(self) -> DataFrame:
        """Not stored: the product overrides read its two dates alone, without the texts."""
        return overrides.event_summary(self.scoped_products)

    @cached_property
    def event_history(self) -> DataFrame:
        """The history texts, stored so that the stage of the wide report does not hold their lists too."""
        return self._cut(text.event_history_text(self.event_summary))

    @cached_property
    def antigens_final(self) -> DataFrame:
        return self._cut(overrides.antigen_overrides(self.antigens_met, self.caveats, self.policy), dealt=True)

    # -- D11-D14 -------------------------------------------------------------
    @cached_property
    def status_base(self) -> DataFrame:
        return status.product_status(self.antigens_final, self.rules, self.policy)

    @cached_property
    def doses(self) -> DataFrame:
        return status.doses_given_required(self.antigens_final)

    @cached_property
    def person_flags(self) -> DataFrame:
        return overrides.person_flags(self.antigens_final, self.caveats, self.event_summary,
                                      self.src.demographics, self.policy)

    @cached_property
    def product_status(self) -> DataFrame:
        return self._cut(overrides.product_overrides(self.status_base, self.person_flags, self.doses))

    @cached_property
    def states(self) -> DataFrame:
        return status.tri_state(self.product_status)

    @cached_property
    def pivots(self) -> DataFrame:
        """State, doses given and doses required of every product, one row a person."""
        return status.pivot_all(self.states, self.doses, self.products)

    @cached_property
    def pivot_state(self) -> DataFrame:
        return status.pivot_part(self.pivots, "state", self.products)

    @cached_property
    def pivot_given(self) -> DataFrame:
        return status.pivot_part(self.pivots, "doses_given", self.products)

    @cached_property
    def pivot_required(self) -> DataFrame:
        return status.pivot_part(self.pivots, "doses_required", self.products)

    # -- D15-D21 -------------------------------------------------------------
    @cached_property
    def core(self) -> DataFrame:
        return report.report_core(self.pivots, self.products)

    @cached_property
    def with_demographics(self) -> DataFrame:
        s, d = self.src, self.dimensions
        return report.demographics_star(self.core, s.population, s.demographics, d["gp"], d["la"], d["postcodes"],
                                        d["deprivation"], d["schools"], self.policy, unique=True, hot=self.hot_codes)

    @cached_property
    def repaired(self) -> DataFrame:
        return report.name_repair(self.with_demographics, self.dimensions["ccg"], self.policy, unique=True)

    @cached_property
    def combined(self) -> DataFrame:
        return report.combined_columns(self.repaired)

    @cached_property
    def final_status(self) -> DataFrame:
        """Product status after the HPV waiver (O27), which runs after the pivot."""
        return overrides_hpv(self.product_status, self.combined, self.policy)

    @cached_property
    def with_hpv(self) -> DataFrame:
        return report.hpv_proxy(self.combined, self.policy)

    @cached_property
    def flagged(self) -> DataFrame:
        return flags.up_to_date(self.with_hpv, self.final_status, self.scoped_antigens,
                                self.policy)

    @cached_property
    def with_texts(self) -> DataFrame:
        s = self.src
        return text.text_summaries(self.flagged, s.consents, self.event_history,
                                   s.non_attendance, s.suspensions)

    @cached_property
    def full_report(self) -> DataFrame:
        out = report.outstanding_list(self.with_texts, self.products)
        out = report.previous_report_flag(out, self.src.previous_report)
        return out.withColumn("va_date", F.lit(self.policy.as_of))

    # -- minimum slice -------------------------------------------------------
    @cached_property
    def slice_product_compliance(self) -> DataFrame:
        """Rule expansion -> windowed counts -> met -> per-product roll-up."""
        m = dosing.met_flags(self.counted)
        return (m.where(F.col("product").isNotNull())
                .groupBy("person_id", "product")
                .agg(F.min("valid_doses_given").alias("doses_given"),
                     F.max("doses_required").alias("doses_required"),
                     F.min("met_flag").alias("met")))


OUTPUTS = ("vaccines_met", "doses_given", "doses_required", "report")


def write_outputs(pipeline: ReportPipeline, base_path: str) -> dict[str, str]:
    """Publish the three pivots and the report (with dense ids) under ``base_path`` as one
    (see :mod:`cohortflow.plans.outputs`); the paths by name. A re-run replaces the earlier one."""
    frames = {"vaccines_met": pipeline.pivot_state, "doses_given": pipeline.pivot_given,
              "doses_required": pipeline.pivot_required,
              "report": with_dense_id(pipeline.full_report, "row_id", pipeline.stages)}
    return publish(pipeline.rules.sparkSession, base_path, {name: frames[name] for name in OUTPUTS})


def overrides_hpv(product_status: DataFrame, rep: DataFrame, policy: C.Policy) -> DataFrame:
    return report.hpv_waiver(product_status, rep, policy)
