import datetime as dt

import pytest
from cohortflow.functions import dates as D

d = dt.date


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


@pytest.mark.parametrize("start,value,unit,expected", [
    (d(2025, 1, 31), 1, "Month", d(2025, 2, 28)),
    (d(2024, 1, 31), 1, "MONTH", d(2024, 2, 29)),
    (d(2024, 2, 29), 1, "Year", d(2025, 2, 28)),
    (d(2024, 2, 29), 4, "year", d(2028, 2, 29)),
    (d(2025, 3, 1), 6, "Week", d(2025, 4, 12)),
    (d(2025, 3, 1), 0, "Week", d(2025, 3, 1)),
    (d(2025, 3, 1), 3, "Day", None),
    (None, 3, "Week", None),
])
def test_add_age(spark, start, value, unit, expected):
    d0 = D.sql_lit(start) if start else "CAST(NULL AS DATE)"
    assert one(spark, D.add_age(d0, value, D.sql_lit(unit))) == expected


@pytest.mark.parametrize("dob,on,months,years", [
    (d(2025, 1, 31), d(2026, 2, 28), 12, 1),
    (d(2024, 2, 29), d(2025, 2, 28), 11, 0),
    (d(2024, 2, 29), d(2025, 3, 1), 12, 1),
    (d(2020, 5, 15), d(2027, 2, 15), 81, 6),
    (d(2020, 5, 16), d(2027, 2, 15), 80, 6),
    (d(2027, 2, 15), d(2027, 2, 15), 0, 0),
])
def test_ages(spark, dob, on, months, years):
    assert one(spark, D.age_in_months(dob, on)) == months
    assert one(spark, D.age_in_years(dob, on)) == years
    assert one(spark, D.full_age(dob, on)) == f"{months // 12} years {months % 12} months"


@pytest.mark.parametrize("day,label,next_label", [
    (d(2027, 2, 15), "2026/27- Q4", "2027/28- Q1"),
    (d(2026, 4, 1), "2026/27- Q1", "2026/27- Q2"),
    (d(2026, 3, 31), "2025/26- Q4", "2026/27- Q1"),
    (d(2099, 12, 31), "2099/00- Q3", "2099/00- Q4"),
])
def test_fin_quarter_labels(spark, day, label, next_label):
    assert one(spark, D.fin_quarter_label(day)) == label
    assert one(spark, D.next_fin_quarter_label(day)) == next_label


def test_calendar_year_diff_is_not_age(spark):
    assert one(spark, D.calendar_year_diff(d(2016, 12, 31), d(2027, 1, 1))) == 11
