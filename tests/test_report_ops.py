"""Cell formatting, combined columns, outstanding list, texts, overrides order, CSV reader."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.operators import overrides, report, text
from cohortflow.sources.schedules import RULE_COLUMNS, read_rules_csv


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


@pytest.mark.parametrize("a,b,expected", [
    (None, None, None), (None, "1.1", "1.1"), ("2.0", None, "2.0"),
    ("1.1", "1.0", "2.0"), ("1.2", "0.1", "1.1"), (".1", "1.1", "1.1"),
    ("1.", "1.1", "2.1"), ("1.1", "1.", None),
])
def test_combine_cells(spark, a, b, expected):
    from cohortflow.functions.dates import sql_lit
    col = F.expr(report.combine_cells_sql(f"CAST({sql_lit(a)} AS STRING)", f"CAST({sql_lit(b)} AS STRING)"))
    assert one(spark, col) == expected


@pytest.mark.parametrize("given,state,expected", [
    (None, None, None), (2, None, "2."), (None, 1, ".1"), (3, 0, "3.0")])
def test_cell(spark, given, state, expected):
    from cohortflow.functions.dates import sql_lit
    assert one(spark, F.expr(report.cell_sql(f"CAST({sql_lit(given)} AS INT)", f"CAST({sql_lit(state)} AS INT)"))) == expected


def test_outstanding_list(spark):
    products = ["4IN1", "HPV", "MMR-1", "MMR-2", "MMRV-1", "MMRV-2"]
    rows = [
        (1, "1.0", "0.2", "0.0", None, "0.0", None),   # MMR-1 -> MMRV-1, MMRV-1 repeat removed
        (2, "1.1", "1.1", None, None, None, None),     # nothing outstanding: single blank
        (3, "0.0", None, None, "0.0", None, "0.0"),    # MMR-2 -> MMRV-2
        (4, None, "0.0", None, None, "0.0", None),     # no MMR-n: MMRV-1 kept
    ]
    df = spark.createDataFrame(rows, ["person_id"] + products)
    got = {r.person_id: r.outstanding_imms
           for r in report.outstanding_list(df, products).collect()}
    assert got == {1: "4IN1, MMRV-1", 2: " ", 3: "4IN1, MMRV-2", 4: "HPV, MMRV-1"}


def test_negative_consent_text(spark):
    rows = [(1, "BCG", "PR", "Reason PR"), (1, "MMR", "B", None), (1, "HPV", "XX", "Reason XX"),
            (2, "BCG", "PR", "Reason PR"), (3, "PCV", "MED", None)]
    df = spark.createDataFrame(rows, "person_id long, vaccine string, reason string, reason_desc string")
    got = {r.person_id: r.negative_consent for r in text.negative_consent_text(df).collect()}
    # person 2 only has BCG: no row; person 3 has no description: NULL text
    assert got == {1: "Reason PR - BCG, MMR", 3: None}


def test_suspension_text(spark):
    a = dt.date(2027, 2, 15)
    rows = [(1, "MMR", "W", "Waiting for records from GP", dt.date(2020, 5, 2), None, a),
            (1, "HPV", "W", "Waiting for records from GP", dt.date(2019, 1, 3), None, a),
            (2, "PCV", "MED", "Susp MED", dt.date(2021, 1, 1), a + dt.timedelta(days=1), a),
            (2, "BCG", "MED", "Susp MED", dt.date(2020, 1, 1), a, a),       # ended: ignored
            (3, "PCV", "ZZ", "Susp ZZ", dt.date(2021, 1, 1), None, a)]     # code not counted
    df = spark.createDataFrame(rows, "person_id long, vaccine string, reason_code string, "
                               "reason_desc string, start_date date, end_date date, va_date date")
    got = {r.person_id: r.suspended for r in text.suspension_text(df).collect()}
    assert got == {1: "Waiting for records from GP from 03/01/2019, 02/05/2020",
                   2: "PCV: Susp MED from 01/01/2021"}


def test_series_overrides_including_any_mmr_product(spark):
    cols = ["person_id", "dob", "antigen", "valid_doses_given", "doses_required", "product",
            "stage", "rule_ref", "prev_ref", "met_flag"]
    d = dt.date(2023, 1, 1)
    rows = [(1, d, "MMR", 2, 1, C.PRODUCT_MMR_ANY_1, "12 Month", 1, None, 1),
            (1, d, "MMR", 3, 1, C.PRODUCT_MMR_1, "12 Month", 2, None, 1),
            (1, d, "MMR", 0, 1, C.PRODUCT_MMRV_1, "12 Month", 3, None, 0),
            (1, d, "MMR", 1, 1, C.PRODUCT_MMRV_2, "18 Month", 4, 3, 1),
            (2, d, "MMR", 0, 1, C.PRODUCT_MMRV_1, "12 Month", 3, None, 0)]
    am = spark.createDataFrame(rows, cols)
    cav = spark.createDataFrame([(1, 3, 1)], "person_id long, valid_dose_count int, mmrv_dose_count int")
    got = {(r.person_id, r.product): (r.valid_doses_given, r.met_flag)
           for r in overrides.series_overrides(am, cav).collect()}
    assert got == {(1, C.PRODUCT_MMR_ANY_1): (2, 1), (1, C.PRODUCT_MMR_1): (1, 1),
                   (1, C.PRODUCT_MMRV_1): (1, 1), (1, C.PRODUCT_MMRV_2): (0, 0),
                   (2, C.PRODUCT_MMRV_1): (0, 0)}


def test_catch_up_order_o10_before_o12(spark):
    """O12 reads MMR-2 'still needed' after O10 cleared it for an unmet MMR-2."""
    status = spark.createDataFrame(
        [(1, "MMR-2", "Preschool", 0, 1), (1, "MMRV-2", "18 Month", 0, 0),
         (2, "MMR-2", "Preschool", 1, 1), (2, "MMRV-2", "18 Month", 0, 0)],
        "person_id long, product string, stage string, min_met int, still_needed int")
    flags = spark.createDataFrame(
        [(p, True, 1, 3, 0, 1, 0, 0, 0, None, None, None, None) for p in (1, 2)],
        "person_id long, has_caveat boolean, catch_up int, cohort int, dose1_is_mmrv int, "
        "valid_dose_count int, cohort2_two_mmrv int, cohort3_invite int, cohort3_late int, "
        "late_6in1 int, hib_met int, acwy_ok int, menc_unmet int")
    doses = spark.createDataFrame([], "person_id long, product string, doses_given int, doses_required int")
    out = overrides.product_overrides(status, flags, doses, ("catchup",))
    got = {(r.person_id, r.product): r.still_needed for r in out.collect()}
    assert got == {(1, "MMR-2"): 0, (1, "MMRV-2"): 0, (2, "MMR-2"): 1, (2, "MMRV-2"): 1}


def test_read_rules_csv(spark, tmp_path):
    header = ("Ref,ChildRef,Immunisation,Dose,DoseOrder,VaccineName,VaccineGroup,ShortName,"
              "AgeSchedFromUnit,AgeSchedFromValue,AgeSchedToUnit,AgeSchedToValue,AgeMissingFromUnit,"
              "AgeMissingFromValue,AgeMissingToUnit,AgeMissingtoValue,DosesSplitByVaccineGroup,"
              "AgeCountedFromUnit,AgeCountedFromValue,AgeCountedToUnit,AgeCountedToValue,Alternate,"
              "DateValidFrom,DateValidTo")
    lines = [header,
             "1,,Thing,1,1,P-1,Primary,abc,Week,8,Week,16,Month,3,Month,12,,Week,0,Year,1,,01/01/1989,31/12/2019",
             '2,1,"Thing, two",2,2,P-2,12 Month,ABC,Week,16,Year,1,Month,5,Month,12,1,Week,0,Year,1,,01/06/2015,']
    p = tmp_path / "rules.csv"
    p.write_text("\n".join(lines) + "\n")
    rows = read_rules_csv(spark, str(p)).orderBy("rule_ref").collect()
    assert [c for c in rows[0].asDict()] == RULE_COLUMNS
    assert rows[0].valid_to == dt.date(2019, 12, 31) and rows[1].valid_to is None
    assert rows[1].prev_ref == 1 and rows[1].split_by_stage == 1 and rows[0].split_by_stage is None
    assert rows[0].antigen == rows[1].antigen == "ABC"


def test_schedule_survives_the_csv_layout(spark, tmp_path):
    """The whole test schedule (products of up to six antigens), written in the CSV layout with
    Windows line ends and codes in other case, reads back as the same rules."""
    import csv

    from cohortflow.sources.schedules import CSV_COLUMNS, parse_schedule
    place = {dst: i for i, dst in enumerate(RULE_COLUMNS)}
    with open(tmp_path / "rules.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator="\r\n")
        out.writerow(["Immunisation", *CSV_COLUMNS])
        for rule in parse_schedule():
            row = {dst: rule[i] for dst, i in place.items()}
            row |= {"antigen": f" {row['antigen'].lower()} ", "stage": row["stage"].upper(), "due_from_unit": row["due_from_unit"]}
            out.writerow(["x, y", *("" if row[d] is None else row[d].strftime("%d/%m/%Y") if isinstance(row[d], dt.date) else row[d] for d in CSV_COLUMNS.values())])
    got = sorted((tuple(r) for r in read_rules_csv(spark, str(tmp_path / "rules.csv")).select(*RULE_COLUMNS).collect()), key=repr)
    assert got == sorted(parse_schedule(), key=repr)
    assert {"TET", "POLIO", "HEPB"} <= {r[place["antigen"]] for r in got}
