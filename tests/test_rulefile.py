"""Rule files with bad lines and broken links."""

import csv
import datetime as dt

from cohortflow.sources.rulefile import link_problems, read_rules_checked
from cohortflow.sources.schedules import CSV_COLUMNS, RULE_COLUMNS, parse_schedule, read_rules_csv, schedule_frame

GOOD = {"Ref": "1", "ChildRef": "", "ShortName": "abc", "Dose": "2", "VaccineName": "P-1", "VaccineGroup": "Primary",
        "AgeMissingFromUnit": "Week", "AgeMissingFromValue": "8", "AgeMissingToUnit": "year", "AgeMissingtoValue": "16",
        "DosesSplitByVaccineGroup": "", "AgeCountedFromUnit": "Week", "AgeCountedFromValue": "0", "AgeCountedToUnit": "Month",
        "AgeCountedToValue": "12", "DateValidFrom": "01/06/2015", "DateValidTo": "", "DoseOrder": "3"}


def written(path, lines, columns=None):
    columns = columns or list(GOOD)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, columns, extrasaction="ignore")
        out.writeheader()
        out.writerows({**GOOD, **x} for x in lines)
    return str(path)


def test_bad_lines_are_set_aside_with_all_reasons(spark, tmp_path):
    lines = [{}, {"Ref": "x2"}, {"Ref": "3", "AgeMissingFromUnit": "Fortnight", "DateValidFrom": "2015-06-01"}, {"Ref": "4", "Dose": "-1", "ShortName": "  "},
             {"Ref": "5", "DateValidTo": "31/05/2015", "DoseOrder": "first"}, {"Ref": "6", "AgeCountedToValue": ""}, {"Ref": "7", "DateValidTo": "31/02/2016"}, {"Ref": " 8 ", "ChildRef": "1"}]
    got = read_rules_checked(spark, written(tmp_path / "r.csv", lines))
    rules = {r.rule_ref: r for r in got.rules.collect()}
    assert set(rules) == {1, 8} and rules[8].prev_ref == 1 and rules[1].antigen == "ABC" and rules[1].dose_order == 3
    assert rules[1].valid_from == dt.date(2015, 6, 1) and rules[1].valid_to is None
    assert {r.Ref: r.reasons for r in got.rejects.collect()} == {
        "x2": ["Ref: no int"], "3": ["AgeMissingFromUnit: unknown unit", "DateValidFrom: no date"],
        "4": ["ShortName: missing", "Dose: negative"], "5": ["DoseOrder: no int", "DateValidTo: before DateValidFrom"],
        "6": ["AgeCountedToValue: missing"], "7": ["DateValidTo: no date"]}
    assert got.problems.count() == 0


def test_a_good_file_reads_as_before(spark, tmp_path):
    place = {dst: i for i, dst in enumerate(RULE_COLUMNS)}
    lines = [{src: "" if (v := rule[place[dst]]) is None else v.strftime("%d/%m/%Y") if isinstance(v, dt.date) else v for src, dst in CSV_COLUMNS.items()} for rule in parse_schedule()]
    path = written(tmp_path / "r.csv", lines, list(CSV_COLUMNS))  # without the order of doses
    got = read_rules_checked(spark, path)
    rows = lambda df: sorted(map(tuple, df.select(*RULE_COLUMNS).collect()), key=repr)
    assert rows(got.rules) == rows(read_rules_csv(spark, path)) and got.rejects.count() == 0
    assert got.rules.where("dose_order IS NOT NULL").count() == 0 and got.problems.count() == 0


def test_links(spark):
    links = [(1, None), (2, 1), (3, 99), (4, 5), (5, 6), (6, 4), (7, 4), (8, 8), (9, 2), (9, 2), (10, 3)] + [(100 + i, 99 + i if i else None) for i in range(40)]
    df = spark.createDataFrame(links, "rule_ref int, prev_ref int")
    got = sorted(map(tuple, link_problems(df, 2000).collect()))
    circle = "its links run in a circle"
    assert got == sorted([(3, "continues a rule that is not there"), (9, "repeated id"), *((i, circle) for i in (4, 5, 6, 7, 8))])
    assert link_problems(df.limit(0), 2000).count() == 0
    assert link_problems(schedule_frame(spark), 2000).count() == 0
