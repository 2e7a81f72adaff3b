"""Calendar arithmetic as native Spark SQL expressions (no Python UDFs).

Each ``*_sql`` function returns Spark SQL expression text over its arguments,
which are themselves SQL text (a column name, an expression or a literal made
with :func:`sql_lit`). The Column versions wrap the text in one ``F.expr``, so
a whole CASE expression costs a single call into the JVM to build and stays
inside whole-stage codegen when it runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SqlArg = str | int | dt.date


def sql_lit(v) -> str:
    """A Python value as a Spark SQL literal."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, dt.date):
        return f"DATE'{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(v)


def _a(x: SqlArg) -> str:
    return sql_lit(x) if isinstance(x, (dt.date, int)) else x


def add_age_sql(d: SqlArg, value: SqlArg, unit: SqlArg) -> str:
    """Date ``d`` plus an age (value, unit); unit Week/Month/Year in any case,
    anything else (or a NULL input) yields NULL. Months clip to the month end."""
    d, value, unit = _a(d), _a(value), _a(unit)
    return (f"(CASE upper(trim({unit})) WHEN 'WEEK' THEN date_add({d}, 7 * CAST({value} AS INT)) "
            f"WHEN 'MONTH' THEN add_months({d}, CAST({value} AS INT)) "
            f"WHEN 'YEAR' THEN add_months({d}, 12 * CAST({value} AS INT)) END)")


def age_steps(name: str, value: str, unit: str) -> list[str]:
    """Select items ``<name>_months`` and ``<name>_days`` of an age (value, unit), for :func:`add_steps_sql`:
    a rule's unit is read once for the rule, not for each person it is due for."""
    u, v = f"upper(trim({unit}))", f"CAST({value} AS INT)"
    return [f"CASE {u} WHEN 'WEEK' THEN 0 WHEN 'MONTH' THEN {v} WHEN 'YEAR' THEN 12 * {v} END AS {name}_months",
            f"CASE WHEN {u} = 'WEEK' THEN 7 * {v} ELSE 0 END AS {name}_days"]


def add_steps_sql(d: SqlArg, name: str) -> str:
    """Date ``d`` plus the age ``name`` of :func:`age_steps`; the same date as :func:`add_age_sql`."""
    return f"date_add(add_months({_a(d)}, {name}_months), {name}_days)"


def latest_birth_sql(on: SqlArg, value: SqlArg, unit: SqlArg) -> str:
    """The last date of birth at which the age (value, unit) is reached by the date ``on``: the
    largest ``d`` with ``add_age(d) <= on``. NULL where :func:`add_age_sql` is NULL."""
    on, value, unit = _a(on), _a(value), _a(unit)

    def months(n: str) -> str:  # from a month's end, all later days of a longer month clip to it
        back = f"add_months({on}, -({n}))"
        return f"CASE WHEN {on} = last_day({on}) THEN last_day({back}) ELSE {back} END"

    return (f"(CASE upper(trim({unit})) WHEN 'WEEK' THEN date_sub({on}, 7 * CAST({value} AS INT)) "
            f"WHEN 'MONTH' THEN {months(f'CAST({value} AS INT)')} "
            f"WHEN 'YEAR' THEN {months(f'12 * CAST({value} AS INT)')} END)")


def age_in_months_sql(dob: SqlArg, on: SqlArg) -> str:
    """Completed months: month-boundary count minus one if the day is not reached."""
    dob, on = _a(dob), _a(on)
    return (f"CAST((year({on}) - year({dob})) * 12 + month({on}) - month({dob}) "
            f"- CASE WHEN day({dob}) > day({on}) THEN 1 ELSE 0 END AS INT)")


def age_in_years_sql(dob: SqlArg, on: SqlArg) -> str:
    """Completed years on ``on``."""
    dob, on = _a(dob), _a(on)
    return (f"CAST(year({on}) - year({dob}) - CASE WHEN month({on}) * 100 + day({on}) "
            f"< month({dob}) * 100 + day({dob}) THEN 1 ELSE 0 END AS INT)")


def full_age_sql(dob: SqlArg, on: SqlArg) -> str:
    """Text age 'Y years M months' from the completed-month age."""
    m = age_in_months_sql(dob, on)
    return f"concat(CAST(({m}) div 12 AS STRING), ' years ', CAST(pmod({m}, 12) AS STRING), ' months')"


def fin_year_sql(d: SqlArg) -> str:
    """April-March financial-year label 'YYYY/YY'."""
    d = _a(d)
    start = f"(CASE WHEN month({d}) >= 4 THEN year({d}) ELSE year({d}) - 1 END)"
    return f"concat(CAST({start} AS STRING), '/', lpad(CAST(({start} + 1) % 100 AS STRING), 2, '0'))"


def fin_quarter_sql(d: SqlArg) -> str:
    """Financial quarter 1..4, April-June being 1."""
    d = _a(d)
    return f"CAST(((month({d}) + 8) % 12) div 3 + 1 AS INT)"


def fin_quarter_label_sql(d: SqlArg) -> str:
    """'YYYY/YY- Qn' label used for cohort cover."""
    return f"concat({fin_year_sql(d)}, '- Q', CAST({fin_quarter_sql(d)} AS STRING))"


def add_age(d: SqlArg, value: SqlArg, unit: SqlArg) -> Column:
    return F.expr(add_age_sql(d, value, unit))


def calendar_year_diff(start: SqlArg, end: SqlArg) -> Column:
    """Number of calendar-year boundaries crossed between two dates (not an age)."""
    return F.expr(f"year({_a(end)}) - year({_a(start)})")


def age_in_months(dob: SqlArg, on: SqlArg) -> Column:
    return F.expr(age_in_months_sql(dob, on))


def age_in_years(dob: SqlArg, on: SqlArg) -> Column:
    return F.expr(age_in_years_sql(dob, on))


def full_age(dob: SqlArg, on: SqlArg) -> Column:
    return F.expr(full_age_sql(dob, on))


def fin_year(d: SqlArg) -> Column:
    return F.expr(fin_year_sql(d))


def fin_quarter(d: SqlArg) -> Column:
    return F.expr(fin_quarter_sql(d))


def fin_quarter_label(d: SqlArg) -> Column:
    return F.expr(fin_quarter_label_sql(d))


def next_fin_quarter_label(on: SqlArg) -> Column:
    """Label of the quarter three months after ``on``."""
    return F.expr(fin_quarter_label_sql(f"add_months({_a(on)}, 3)"))
