"""Policy parameters and the fixed vocabulary of the compliance report.

Everything the operators compare against (product, antigen and stage names,
reason codes, policy dates, age gates) lives here so that the operators stay
usable with any schedule table: pass a different :class:`Policy` to change them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values of the reporting process being
# reproduced; they are stated here plainly and in one place.
# ---------------------------------------------------------------------------

# Antigen code aliases applied to event codes before matching rules.
ANTIGEN_ALIASES = (("MENW", "ACWY"), ("CPOX", "VAR"))
# Antigen doses recorded on a booster product coded as a primary dose are dropped.
BOOSTER_PRODUCT_CODE = "4IN1"
BOOSTER_EXCLUDED_ANTIGENS = ("DIPH", "TET", "PERT", "POL")
PRIMARY_DOSE_SUFFIX = "P"
# MMR-containing product codes and the combined (MMRV) code.
MMR_CONTAINING_CODES = ("MMR", "MMRV")
COMBINED_CODE = "MMRV"
SIX_IN_ONE_CODE = "6IN1"
ACWY_DESCRIPTION = "Meningitis ACWY"
# Report products with special handling.
PRODUCT_MMR_1 = "MMR-1"
PRODUCT_MMR_2 = "MMR-2"
PRODUCT_MMRV_1 = "MMRV-1"
PRODUCT_MMRV_2 = "MMRV-2"
PRODUCT_MMR_ANY_1 = "MMR(V)-1"
PRODUCT_MMR_ANY_2 = "MMR(V)-2"
PRODUCT_SIX_IN_ONE_18M = "6IN1-18Month"
PRODUCT_HIBMENC = "HIBMENC"
PRODUCT_HPV = "HPV"
PRODUCT_ROTA = "ROTA"
PERT_WAIVER_PRODUCTS = ("6IN1-Primary", "6IN1-18Month", "4IN1")
ANTIGEN_MENB = "MENB"
ANTIGEN_PERT = "PERT"
ANTIGEN_HIB = "HIB"
ANTIGEN_MENC = "MENC"
# Stage (schedule group) names.
STAGE_PRIMARY = "Primary"
STAGE_12M = "12 Month"
STAGE_18M = "18 Month"
STAGE_PRESCHOOL = "Preschool"
STAGE_SCHOOL = "School"
# Spellings that rule tables in other case are brought to.
KNOWN_PRODUCTS = (PRODUCT_MMR_1, PRODUCT_MMR_2, PRODUCT_MMRV_1, PRODUCT_MMRV_2, PRODUCT_MMR_ANY_1,
                  PRODUCT_MMR_ANY_2, PRODUCT_HIBMENC, PRODUCT_HPV, PRODUCT_ROTA) + PERT_WAIVER_PRODUCTS
KNOWN_STAGES = (STAGE_PRIMARY, STAGE_12M, STAGE_18M, STAGE_PRESCHOOL, STAGE_SCHOOL)
# Status texts.
NO_RECORD = "No Record"
YES = "Yes"
NO = "No"
# Negative consent and suspension reason codes that count.
CONSENT_REASONS = ("PR", "34", "B", "REF", "NPC", "PREF", "MED")
CONSENT_EXCLUDED_VACCINE = "BCG"
SUSPENSION_REASONS = ("MED", "W", "M", "VS", "AC", "IIR", "PRIV")
SUSPENSION_WAITING_PREFIX = "Waiting for records"
# Locality renames and fallbacks in the demographic enrichment.
LOCALITY_RENAMES = (("East", "TV"), ("West", "BGSW"))
OUT_OF_AREA_LA = "Out of Area LA"
OUT_OF_AREA_CCG = "Out of Area CCG"
AGE_GROUPS = ((6, "0-5"), (19, "6-19"), (None, "19+"))
COVER_COHORTS = (("cohort_12m", "12MonthCohort"), ("cohort_24m", "24MonthCohort"),
                 ("cohort_5y", "5YearCohort"))
HPV_PROXY_SUFFIX = ".4"
OPEN_END_DATE = dt.date(9999, 12, 31)


@dataclass(frozen=True)
class StageGate:
    """When a person without any record is reported as 'No Record' for a stage."""

    stage: str
    column: str
    min_age_months: int | None = None
    min_age_years: int | None = None
    always: bool = False


@dataclass(frozen=True)
class Policy:
    """Dates and thresholds of the compliance rules; ``as_of`` is the report date."""

    as_of: dt.date
    min_population_age_months: int = 3
    catch_up_from: dt.date = dt.date(2026, 1, 1)
    mmr_valid_from_age_months: int = 12
    late_second_dose_age_months: int = 40
    six_in_one_late_age_months: int = 12
    acwy_valid_from_weeks: int = 51
    pert_waiver_year_diff: int = 10
    hpv_boys_born_before: dt.date = dt.date(2006, 9, 1)
    stage18_report_after: dt.date = dt.date(2025, 12, 31)
    stage18_born_from: dt.date = dt.date(2022, 9, 1)
    stage18_products: tuple[str, ...] = (PRODUCT_SIX_IN_ONE_18M, PRODUCT_MMRV_2)
    gates: tuple[StageGate, ...] = field(default_factory=lambda: (
        StageGate(STAGE_PRIMARY, "up_to_date_primary", always=True),
        StageGate(STAGE_12M, "up_to_date_12_month", min_age_months=14),
        StageGate(STAGE_18M, "up_to_date_18_month", min_age_months=19),
        StageGate(STAGE_PRESCHOOL, "up_to_date_preschool", min_age_months=42),
        StageGate(STAGE_SCHOOL, "up_to_date_school", min_age_years=14),
    ))
    # A rule table with more rows is refused: rules (and what is derived from rules and calendar days
    # alone) are the only frames that are broadcast, so this bounds every broadcast.
    max_rules: int = 2_000
    # Words of 64 bits in the bit set by which events of people out of scope are left out before they
    # are shuffled; it is broadcast, 16 bytes a word. 0: no such filter.
    scope_filter_words: int = 1 << 20
    # Antigen codes are cut to this length before they are compared.
    antigen_code_length: int = 10
    # At most so many date-of-birth bands of the combined vaccine are numbered.
    max_combined_cohorts: int = 3


# The report date used by the registered queries and the tests.
DEFAULT_AS_OF = dt.date(2027, 2, 15)
DEFAULT_POLICY = Policy(as_of=DEFAULT_AS_OF)
