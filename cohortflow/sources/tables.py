"""The named inputs of the compliance report, with ingestion clean-up."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sources:
    """Input tables. Person-keyed tables use ``person_id``; see README for columns.

    population        person_id, dob, va_date, forename, surname, gender, postcode,
                      gp_code, ccg_code, la_code
    events_by_product person_id, vaccine_code, vaccine_part, vaccine_desc, event_date
    events_by_antigen person_id, antigen_code, antigen_dose, event_date
    demographics      person_id, dob, local_id, contact_numbers, school_code, school_name,
                      school_in_area, age_text, ethnic_code, ethnic_description, va_date,
                      forename, surname, sex, practice_code, practice_name, ccg_code,
                      postcode, la_code, cohort_12m, cohort_24m, cohort_5y
    gp / la / ccg / postcodes / deprivation / schools   reference dimensions
    consents          person_id, vaccine, reason, reason_desc
    suspensions       person_id, vaccine, reason_code, reason_desc, start_date,
                      end_date, va_date
    non_attendance    person_id, dna_text
    previous_report   person_id

    ``by_person``: both event logs are stored by person, so grouping them by person needs no exchange.
    """

    population: DataFrame
    events_by_product: DataFrame
    events_by_antigen: DataFrame
    demographics: DataFrame
    gp: DataFrame
    la: DataFrame
    ccg: DataFrame
    postcodes: DataFrame
    deprivation: DataFrame
    schools: DataFrame
    consents: DataFrame
    suspensions: DataFrame
    non_attendance: DataFrame
    previous_report: DataFrame
    by_person: bool = False

    def cleaned(self) -> "Sources":
        """Drop rows without a person id and normalise event codes, parts and doses.

        A NULL person id can never be reported and would make every ``NOT IN`` membership test
        unknown, so it is removed at ingestion. Codes are compared in upper case; the code as it
        was given stays in ``vaccine_text`` for the report's texts.
        """
        def key(c: str) -> F.Column:
            return F.upper(F.trim(F.col(c)))

        out = {}
        for f in fields(self):
            df = getattr(self, f.name)
            if not isinstance(df, DataFrame):
                continue
            if "person_id" in df.columns:
                df = df.where(F.col("person_id").isNotNull())
            out[f.name] = df
        product = out["events_by_product"]
        out["events_by_product"] = product.withColumns({
            "vaccine_text": F.col("vaccine_text" if "vaccine_text" in product.columns else "vaccine_code"),
            "vaccine_code": key("vaccine_code"), "vaccine_part": key("vaccine_part")})
        out["events_by_antigen"] = out["events_by_antigen"].withColumns({
            "antigen_code": key("antigen_code"), "antigen_dose": key("antigen_dose")})
        return replace(self, **out)
