"""Schedule (rule) tables: schema, CSV reader and the built-in test schedule.

A rule says: people born inside [valid_from, valid_to] are due ``doses_required``
doses of ``antigen`` for ``product`` once they reach the ``due_from`` age, and
events between the ``count_from`` and ``count_to`` ages count towards it.
``prev_ref`` links a rule to the rule of the earlier stage it continues.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import config as C
from cohortflow.sources.local import local_frame

RULE_SCHEMA = T.StructType([
    T.StructField("rule_ref", T.IntegerType()),
    T.StructField("prev_ref", T.IntegerType()),
    T.StructField("antigen", T.StringType()),
    T.StructField("doses_required", T.IntegerType()),
    T.StructField("product", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("due_from_unit", T.StringType()),
    T.StructField("due_from_value", T.IntegerType()),
    T.StructField("due_to_unit", T.StringType()),
    T.StructField("due_to_value", T.IntegerType()),
    T.StructField("split_by_stage", T.IntegerType()),
    T.StructField("count_from_unit", T.StringType()),
    T.StructField("count_from_value", T.IntegerType()),
    T.StructField("count_to_unit", T.StringType()),
    T.StructField("count_to_value", T.IntegerType()),
    T.StructField("valid_from", T.DateType()),
    T.StructField("valid_to", T.DateType()),
])
RULE_COLUMNS = [f.name for f in RULE_SCHEMA.fields]

# Column names of the published rule CSV layout, mapped to ours.
CSV_COLUMNS = {
    "Ref": "rule_ref", "ChildRef": "prev_ref", "ShortName": "antigen", "Dose": "doses_required",
    "VaccineName": "product", "VaccineGroup": "stage",
    "AgeMissingFromUnit": "due_from_unit", "AgeMissingFromValue": "due_from_value",
    "AgeMissingToUnit": "due_to_unit", "AgeMissingtoValue": "due_to_value",
    "DosesSplitByVaccineGroup": "split_by_stage",
    "AgeCountedFromUnit": "count_from_unit", "AgeCountedFromValue": "count_from_value",
    "AgeCountedToUnit": "count_to_unit", "AgeCountedToValue": "count_to_value",
    "DateValidFrom": "valid_from", "DateValidTo": "valid_to",
}

_UNITS = {"W": "Week", "M": "Month", "Y": "Year"}

# Test schedule, invented for the synthetic population: stages overlap and validities break so that
# every allocation branch and every override fires. Antigens are grouped, whatever the product.
# rule|prev|antigen|required|product|stage|due_from|due_to|split|count_from|count_to|dob_from|dob_to
TEST_SCHEDULE = """
1||DIPH|1|6IN1-Primary|Primary|W14|Y19||W5|Y19|1988-03-01|
2||MENB|1|MENB-Primary|Primary|W13|M11||W5|M11|2014-11-01|
3||ROTA|1|ROTA|Primary|W11|W18||W5|W26|1988-03-01|
4||DIPH|2|6IN1-Primary|Primary|W18|Y19||W0|Y19|1988-03-01|
5||DIPH|3|6IN1-Primary|Primary|W23|Y19||W0|Y19|1988-03-01|
6|5|DIPH|1|4IN1|Preschool|M40|Y19|1|M34|Y19|1988-03-01|2024-04-30
7|6|DIPH|1|DTP|School|Y14|Y19||Y10|Y19|1988-03-01|
8|5|DIPH|1|6IN1-18Month|18 Month|M18|Y19|1|M14|Y19|2024-05-01|
9||HEPB|3|6IN1-Primary|Primary|W23|Y19||W0|Y19|2016-10-01|
10||HIB|3|6IN1-Primary|Primary|W23|Y19||W0|Y19|1988-03-01|
11||POLIO|3|6IN1-Primary|Primary|W23|Y19||W0|Y19|1988-03-01|
12||TET|3|6IN1-Primary|Primary|W23|Y19||W0|Y19|1988-03-01|
13||HIB|1|HIBMENC|12 Month|M13|Y11||W50|Y19|2006-04-01|2024-04-30
14||MENC|1|HIBMENC|12 Month|M13|Y11||W50|Y19|2006-04-01|2024-04-30
15||ROTA|2|ROTA|Primary|W15|W26||W5|W26|1988-03-01|
16||MENB|2|MENB-Primary|Primary|W17|M11||W0|M11|2014-11-01|
17|16|MENB|1|MENB-12Month|12 Month|M13|Y3||M11|Y19|2014-11-01|
18||PERT|3|6IN1-Primary|Primary|W23|Y19||W0|Y19|1988-03-01|
19|18|PERT|1|6IN1-18Month|18 Month|M18|Y19||M14|Y19|2024-05-01|
20|18|PERT|1|4IN1|Preschool|M40|Y19|1|M34|Y19|1988-03-01|2024-04-30
21||PCV|1|PCV-Primary|Primary|W22|M13||W5|M12|2019-05-01|
22|21|PCV|1|PCV-12Month|12 Month|M13|M27||M12|M27|2019-05-01|
23||ACWY|1|MEACWY|School|Y14|Y19||Y9|Y19|1988-03-01|
24||HPV|1|HPV|School|Y13|Y24||Y11|Y13|1988-03-01|
25|24|HPV|1|HPV-B|School|Y14|Y19||Y11|Y19|1988-03-01|
26||VAR|1|MMRV-1|12 Month|M13|Y19|1|M12|Y19|2024-11-01|
27|26|VAR|1|MMRV-2|18 Month|M18|Y19|1|M12|Y19|2024-11-01|
28||VAR|1|MMRV-1|12 Month|M18|Y19|1|M12|Y19|2024-05-01|2024-10-31
29|28|VAR|1|MMRV-2|18 Month|M23|Y19|1|M12|Y19|2024-05-01|2024-10-31
30||VAR|1|MMRV-1|12 Month|M28|M50|1|M12|Y19|2022-05-01|2024-04-30
31|30|VAR|1|MMRV-2|18 Month|M28|M38|1|M12|Y19|2022-05-01|2024-04-30
32||MMR|1|MMRV-1|12 Month|M13|Y19|1|M12|Y19|2024-11-01|
33|32|MMR|1|MMRV-2|18 Month|M18|Y19|1|M12|Y19|2024-11-01|
34||MMR|1|MMRV-1|12 Month|M18|Y19|1|M12|Y19|2024-05-01|2024-10-31
35|34|MMR|1|MMRV-2|18 Month|M23|Y19|1|M12|Y19|2024-05-01|2024-10-31
36||MMR|1|MMRV-1|12 Month|M28|M50|1|M12|Y19|2022-05-01|2024-04-30
37|36|MMR|1|MMRV-2|18 Month|M28|M38|1|M12|Y19|2022-05-01|2024-04-30
38||MMR|1|MMR-1|12 Month|M13|Y19|0|M12|Y19|1988-03-01|2024-10-31
39|38|MMR|1|MMR-2|Preschool|M40|Y19|1|M12|Y19|1988-03-01|2022-04-30
40||MMR|1|MMR-2|Preschool|M40|Y19||M12|Y19|2022-05-01|2022-12-31
41|38|MMR|1|MMR-2|Preschool|M40|Y19|1|M12|Y19|2023-01-01|2023-11-30
42||MMR|1|MMR-2|Preschool|M28|Y19||M12|Y19|2023-12-01|2024-04-30
43||MMR|2|MMR-1|Preschool|M40|Y19||M12|Y19|2009-06-01|2012-02-29
"""

# The same schedule with a product that any MMR-containing dose counts for.
ANY_MMR_SCHEDULE = TEST_SCHEDULE + "44||MMR|2|MMR(V)-1|12 Month|M13|Y19||M12|Y19|1988-03-01|\n"


def _age(token: str) -> tuple[str, int]:
    return _UNITS[token[0]], int(token[1:])


def _opt_int(s: str) -> int | None:
    return int(s) if s.strip() else None


def _opt_date(s: str) -> dt.date | None:
    return dt.date.fromisoformat(s) if s.strip() else None


def parse_schedule(text: str = TEST_SCHEDULE) -> list[tuple]:
    """Parse the compact pipe-separated schedule into rows of :data:`RULE_SCHEMA`."""
    rows = []
    for line in text.strip().splitlines():
        (ref, prev, antigen, req, product, stage, due_from, due_to, split,
         count_from, count_to, dob_from, dob_to) = line.split("|")
        df_u, df_v = _age(due_from)
        dt_u, dt_v = _age(due_to)
        cf_u, cf_v = _age(count_from)
        ct_u, ct_v = _age(count_to)
        rows.append((int(ref), _opt_int(prev), antigen, int(req), product, stage,
                     df_u, df_v, dt_u, dt_v, _opt_int(split), cf_u, cf_v, ct_u, ct_v,
                     _opt_date(dob_from), _opt_date(dob_to)))
    return rows


def schedule_frame(spark: SparkSession, text: str = TEST_SCHEDULE) -> DataFrame:
    """The schedule as a small JVM-side DataFrame (tens of rows)."""
    return local_frame(spark, parse_schedule(text), RULE_SCHEMA)


def normalised_rules(rules: DataFrame) -> DataFrame:
    """Rules whose antigens are upper case and whose products and stages carry the spelling that the
    operators compare with, whatever case they came in; other names are only trimmed."""
    def known(column: str, names) -> F.Column:
        c, out = F.trim(F.col(column)), F.trim(F.col(column))
        for name in names:
            out = F.when(F.upper(c) == name.upper(), F.lit(name)).otherwise(out)
        return out

    return rules.withColumns({"antigen": F.upper(F.trim("antigen")), "product": known("product", C.KNOWN_PRODUCTS),
                              "stage": known("stage", C.KNOWN_STAGES)})


def read_rules_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a rule CSV in the published layout (dd/MM/yyyy dates, blank = open end).

    Codes are trimmed and normalised (`normalised_rules`), so comparisons do not depend on case.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    cols = []
    for src, dst in CSV_COLUMNS.items():
        c = F.trim(F.col(f"`{src}`"))
        c = F.when(c == "", None).otherwise(c)
        typ = RULE_SCHEMA[dst].dataType
        if isinstance(typ, T.DateType):
            c = F.to_date(c, "dd/MM/yyyy")
        elif isinstance(typ, T.IntegerType):
            c = c.cast("int")
        cols.append(c.alias(dst))
    return normalised_rules(raw.select(*cols))
