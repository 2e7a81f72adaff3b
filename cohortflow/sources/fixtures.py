"""Synthetic compliance inputs derived from the driver's TPC-H-style tables.

Customers become people, line items become immunisation events (one product
per line item, at a nominal age plus jitter), suppliers/nations/parts become
reference dimensions, and the ``events`` table supplies consents and
non-attendance. Integer and date arithmetic only, so the DuckDB oracle can
derive identical inputs (see :mod:`cohortflow.plans.oracle`).

Every row of every table is used: people without a record, unmatched codes and
rows outside the report come from how keys are mapped, never from leaving rows
out. The only filters are those of the model itself: events lie on or before
the report date, ``error`` events are consents and ``signup`` events missed
appointments. Some codes come in lower case, as real feeds have them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions.dates import fin_quarter_label_sql, sql_lit
from cohortflow.plans.sizing import cut_lineage
from cohortflow.sources.local import local_frame
from cohortflow.sources.tables import Sources

# Event slots: (slot, product code, nominal age in days).
SLOTS = [
    (0, "6IN1", 56), (1, "6IN1", 84), (2, "6IN1", 112), (3, "ROTA", 56), (4, "ROTA", 84),
    (5, "PCV", 84), (6, "PCV", 370), (7, "MENB", 56), (8, "MENB", 112), (9, "MENB", 370),
    (10, "HIBMENC", 370), (11, "MMR", 370), (12, "MMR", 1220), (13, "MMRV", 370),
    (14, "MMRV", 550), (15, "6IN1", 550), (16, "4IN1", 1220), (17, "HPV", 4400),
    (18, "MENACWY", 4800), (19, "DTP", 4800), (20, "HPV", 5200),
]
N_SLOTS = len(SLOTS)

# Antigen codes recorded for each product code (raw codes, before aliasing).
PRODUCT_ANTIGENS = [
    ("6IN1", "DIPH"), ("6IN1", "PERT"), ("6IN1", "HIB"), ("6IN1", "TET"),
    ("6IN1", "POLIO"), ("6IN1", "HEPB"), ("4IN1", "DIPH"), ("4IN1", "PERT"),
    ("DTP", "DIPH"), ("HIBMENC", "HIB"), ("HIBMENC", "MENC"), ("MMR", "MMR"), ("MMRV", "MMR"),
    ("MMRV", "CPOX"), ("MENACWY", "MENW"), ("PCV", "PCV"), ("MENB", "MENB"), ("ROTA", "ROTA"),
    ("HPV", "HPV"),
]

CONSENT_VACCINES = ["BCG", "MMR", "6IN1", "HPV", "PCV"]
CONSENT_REASON_CODES = ["PR", "34", "B", "REF", "NPC", "PREF", "MED", "XX"]
SUSPENSION_CODES = ["MED", "W", "M", "VS", "AC", "IIR", "PRIV", "ZZ"]
HUBS = ["East", "West", "North"]
# There are ten customers to a user; an event's number says which of them it concerns.
EVENT_PERSON = "user_id * 10 + event_id % 10"
FIXTURE_ANCHOR_DOB = dt.date(1985, 6, 1)

TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")

def pick(values: list[str], index: str) -> str:
    """SQL CASE giving values[index] (index is 0-based SQL text)."""
    return "CASE " + " ".join(f"WHEN {index} = {i} THEN {sql_lit(v)}"
                              for i, v in enumerate(values)) + " END"


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}


def mixed_case(value: str, low: str) -> str:
    """SQL: ``value``, in lower case where ``low`` holds."""
    return f"CASE WHEN {low} THEN lower({value}) ELSE {value} END"


def population(t: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    a = sql_lit(as_of)
    return t["customer"].selectExpr(
        "c_custkey AS person_id",
        f"""CASE WHEN c_custkey % 97 = 5 THEN {sql_lit(FIXTURE_ANCHOR_DOB)}
                 WHEN c_custkey % 2 = 0 THEN date_sub({a}, CAST((c_custkey * 7919) % 1700 AS INT))
                 ELSE date_sub({a}, CAST((c_custkey * 7919) % 9000 AS INT)) END AS dob""",
        f"{a} AS va_date",
        "c_mktsegment AS forename",
        "c_name AS surname",
        "CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END AS gender",
        "CAST((c_custkey * 3) DIV 2 AS STRING) AS postcode",
        "CASE WHEN c_custkey % 37 != 0 THEN CAST(c_custkey DIV 12 AS STRING) END AS gp_code",
        "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST((c_custkey * 5) % 30 AS STRING) END AS ccg_code",
        "CAST(c_nationkey + CASE WHEN c_custkey % 6 = 0 THEN 100 ELSE 0 END AS STRING) AS la_code",
    )


def events_by_product(spark: SparkSession, t: dict[str, DataFrame], pop: DataFrame,
                      as_of: dt.date) -> DataFrame:
    """One immunisation event per line item at the nominal age of its slot plus a part-key
    jitter. Customers of every seventeenth kind have no record: their orders count for the
    customer before them. Two of three people have few MMR-containing events: most of theirs
    move to later slots, so that short dose series occur as well as long ones."""
    slots = local_frame(spark, SLOTS, "slot INT, vaccine_code STRING, age_days INT")
    li = t["lineitem"].selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey",
        f"CAST((l_orderkey * 5 + l_linenumber * 3) % {N_SLOTS} AS INT) AS slot0")
    slot = ("CASE WHEN slot0 BETWEEN 11 AND 14 AND o_custkey % 3 != 0 AND l_orderkey % 8 != 0 "
            "THEN slot0 + 5 ELSE slot0 END")
    orders = t["orders"].selectExpr(
        "o_orderkey", "o_custkey - CASE WHEN o_custkey % 17 = 3 THEN 1 ELSE 0 END AS o_custkey")
    people = pop.selectExpr("person_id AS o_custkey", "dob")
    ev = (li.join(orders, li.l_orderkey == orders.o_orderkey)
          .withColumn("slot", F.expr(slot))
          .join(people, "o_custkey")
          .join(F.broadcast(slots), "slot")
          .selectExpr("*", "date_add(dob, CAST(age_days + l_partkey % 61 - 10 AS INT)) AS event_date")
          .where(f"event_date <= {sql_lit(as_of)}"))
    part = """CASE WHEN slot IN (0, 3, 5, 7) OR (vaccine_code = '4IN1' AND l_suppkey % 4 = 0) THEN '1P'
                   WHEN slot IN (1, 4, 8) THEN '2P' WHEN slot = 2 THEN '3P' ELSE '1B' END"""
    desc = "CASE WHEN vaccine_code = 'MENACWY' THEN 'Meningitis ACWY' ELSE vaccine_code END"
    return ev.selectExpr(
        "o_custkey AS person_id",
        f"{mixed_case('vaccine_code', 'l_partkey % 10 = 0')} AS vaccine_code",
        f"{mixed_case(part, 'l_partkey % 7 = 0')} AS vaccine_part",
        f"{mixed_case(desc, 'l_partkey % 5 = 0')} AS vaccine_desc",
        "event_date")


def events_by_antigen(spark: SparkSession, by_product: DataFrame) -> DataFrame:
    pa = local_frame(spark, PRODUCT_ANTIGENS, "vaccine_code STRING, antigen_code STRING")
    return (by_product.withColumn("vaccine_code", F.upper("vaccine_code"))
            .join(F.broadcast(pa), "vaccine_code")
            .selectExpr("person_id", f"{mixed_case('antigen_code', 'day(event_date) % 4 = 0')} AS antigen_code",
                        "vaccine_part AS antigen_dose", "event_date"))


def demographics(t: dict[str, DataFrame], pop: DataFrame, as_of: dt.date) -> DataFrame:
    # Every nineteenth local record is filed under an id that the register does not know.
    c = (t["customer"]
         .join(pop.selectExpr("person_id AS c_custkey", "dob AS pop_dob"), "c_custkey")
         .selectExpr("*", "date_add(pop_dob, CASE WHEN c_custkey % 23 = 0 THEN 1 ELSE 0 END) AS dob"))
    return c.selectExpr(
        "CASE WHEN c_custkey % 19 = 0 THEN -1 - c_custkey ELSE c_custkey END AS person_id", "dob",
        "concat('L', CAST(c_custkey AS STRING)) AS local_id",
        "concat('0700', CAST(c_custkey AS STRING)) AS contact_numbers",
        "CAST(c_custkey DIV 14 AS STRING) AS school_code",
        "concat('School ', CAST(c_custkey DIV 14 AS STRING)) AS school_name",
        "CAST(c_custkey % 2 AS INT) AS school_in_area",
        "CAST(c_custkey % 90 AS STRING) AS age_text",
        "concat('E', CAST(c_custkey % 5 AS STRING)) AS ethnic_code",
        "concat('Ethnic ', CAST(c_custkey % 5 AS STRING)) AS ethnic_description",
        f"{sql_lit(as_of)} AS va_date",
        "c_mktsegment AS forename", "c_name AS surname",
        "CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END AS sex",
        "CAST((c_custkey + 1) DIV 12 AS STRING) AS practice_code",
        "concat('Practice ', CAST((c_custkey + 1) DIV 12 AS STRING)) AS practice_name",
        "CAST((c_custkey * 5 + 1) % 30 AS STRING) AS ccg_code",
        "CAST((c_custkey * 3) DIV 2 + 1 AS STRING) AS postcode",
        "CAST((c_nationkey + 1) % 25 + CASE WHEN c_custkey % 7 = 0 THEN 100 ELSE 0 END AS STRING) AS la_code",
        f"{fin_quarter_label_sql('add_months(dob, 12)')} AS cohort_12m",
        f"{fin_quarter_label_sql('add_months(dob, 24)')} AS cohort_24m",
        f"{fin_quarter_label_sql('add_months(dob, 60)')} AS cohort_5y",
    )


def gp_dim(t: dict[str, DataFrame]) -> DataFrame:
    return t["supplier"].selectExpr(
        "CAST(s_suppkey AS STRING) AS practice_code",
        "s_name AS practice_name",
        f"{pick(HUBS, 's_nationkey % 3')} AS hub",
        "CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE concat('CCG ', CAST(s_nationkey AS STRING)) END"
        " AS ccg_description",
        "CAST(s_nationkey % 7 AS STRING) AS pcn_code",
        "concat('PCN ', CAST(s_nationkey % 7 AS STRING)) AS pcn_name",
    )


def la_dim(t: dict[str, DataFrame]) -> DataFrame:
    return t["nation"].selectExpr(
        "CAST(n_nationkey AS STRING) AS la_code", "n_name AS la_name",
        f"{pick(HUBS, 'n_regionkey % 3')} AS hub")


def ccg_dim(t: dict[str, DataFrame]) -> DataFrame:
    return t["nation"].selectExpr("CAST(n_nationkey AS STRING) AS ccg_code", "n_name AS ccg_name")


def postcode_dim(t: dict[str, DataFrame]) -> DataFrame:
    return t["part"].selectExpr(
        "CAST(p_partkey AS STRING) AS postcode", "p_brand AS ward_code", "p_type AS ward_name",
        "CAST(p_size AS STRING) AS lsoa")


def deprivation_dim(t: dict[str, DataFrame]) -> DataFrame:
    """Every seventh area is listed under a code that no postcode has."""
    return (t["part"]
            .selectExpr("CASE WHEN p_size % 7 = 0 THEN concat('X', CAST(p_size AS STRING)) ELSE CAST(p_size AS STRING) END AS lsoa",
                        "CAST(p_size % 10 + 1 AS INT) AS imd_decile")
            .distinct())


def school_dim(t: dict[str, DataFrame]) -> DataFrame:
    return t["supplier"].selectExpr(
        "CAST(s_suppkey AS STRING) AS school_code",
        "concat('C', CAST(s_nationkey AS STRING)) AS contract")


def consents(t: dict[str, DataFrame]) -> DataFrame:
    reason = pick(CONSENT_REASON_CODES, "event_id % 8")
    return t["events"].where("event_type = 'error'").selectExpr(
        f"{EVENT_PERSON} AS person_id",
        f"{pick(CONSENT_VACCINES, 'event_id % 5')} AS vaccine",
        f"{mixed_case(reason, 'event_id % 3 = 0')} AS reason",
        f"CASE WHEN event_id % 8 = 2 THEN NULL ELSE concat('Reason ', {reason}) END AS reason_desc",
    )


def suspensions(t: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    a = sql_lit(as_of)
    code = pick(SUSPENSION_CODES, "o_orderkey % 8")
    return t["orders"].selectExpr(
        "o_custkey AS person_id",
        f"{pick(CONSENT_VACCINES, 'o_orderkey % 5')} AS vaccine",
        f"{mixed_case(code, 'o_orderkey % 3 = 0')} AS reason_code",
        f"CASE WHEN {code} = 'W' THEN 'Waiting for records from GP' ELSE concat('Susp ', {code}) END"
        " AS reason_desc",
        "to_date(o_orderdate) AS start_date",
        f"CASE o_orderstatus WHEN 'F' THEN date_sub({a}, 30) WHEN 'O' THEN date_add({a}, 30) END"
        " AS end_date",
        f"{a} AS va_date",
    )


def non_attendance(t: dict[str, DataFrame]) -> DataFrame:
    return (t["events"].where("event_type = 'signup'")
            .groupBy(F.expr(EVENT_PERSON).alias("person_id"))
            .agg(F.expr("concat(CAST(count(1) AS STRING), ' missed')").alias("dna_text")))


def previous_report(t: dict[str, DataFrame]) -> DataFrame:
    """Ids of an earlier report; two thirds of them are not in the population any more."""
    return t["customer"].selectExpr("c_custkey * 3 AS person_id")


def derive_sources(spark: SparkSession, sf_dir: str, as_of: dt.date,
                   materialize: bool = True) -> Sources:
    """All compliance inputs for one driver data directory.

    The product-level events come from a three-way join and are read by five
    report stages; with ``materialize`` they are written once to the session's
    shared checkpoint folder (when it names one), bucketed by person, instead of being
    re-derived and dealt by person for each read. The antigen-level events are a broadcast join over them and stay lazy.
    """
    t = read_tables(spark, sf_dir)
    pop = population(t, as_of)
    bp = events_by_product(spark, t, pop, as_of)
    stored = cut_lineage(bp, "person_id") if materialize else bp
    by_person, bp = stored is not bp, stored
    ba = events_by_antigen(spark, bp)
    return Sources(
        population=pop,
        events_by_product=bp,
        events_by_antigen=ba,
        demographics=demographics(t, pop, as_of),
        gp=gp_dim(t), la=la_dim(t), ccg=ccg_dim(t), postcodes=postcode_dim(t),
        deprivation=deprivation_dim(t), schools=school_dim(t),
        consents=consents(t), suspensions=suspensions(t, as_of),
        non_attendance=non_attendance(t), previous_report=previous_report(t), by_person=by_person,
    )


