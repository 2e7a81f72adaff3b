"""Per-person text summaries: consents, history, non-attendance, suspensions.

Each is a single ``groupBy(person)`` whose list aggregates are distinct sets
(combined map-side), sorted, then joined with ', '. A list with no values is
NULL, and texts are built with NULL-propagating ``concat``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions.dates import sql_lit
from cohortflow.functions.text import distinct_list


def _counts(column: str, values) -> str:
    return f"upper(trim({column})) IN ({', '.join(sql_lit(v) for v in values)})"


def negative_consent_text(consents: DataFrame) -> DataFrame:
    """O35: '<reasons> - <vaccines>' over counting reasons, for people with at
    least one counting consent on a vaccine other than the excluded one (which
    is still listed for them)."""
    s = consents.where(_counts("reason", C.CONSENT_REASONS)).groupBy("person_id").agg(
        F.expr(f"max(CASE WHEN upper(trim(vaccine)) != {sql_lit(C.CONSENT_EXCLUDED_VACCINE)} THEN 1 END)")
        .alias("_other"),
        distinct_list("vaccine").alias("_vaccines"),
        distinct_list("reason_desc").alias("_descs"))
    return s.where("_other = 1").selectExpr(
        "person_id", "concat(_descs, ' - ', _vaccines) AS negative_consent")


def history_list() -> F.Column:
    """Aggregate: distinct '<code as given> - <yyyy-mm-dd>' entries, sorted."""
    return distinct_list("concat(vaccine_text, ' - ', CAST(event_date AS STRING))")


def event_history_text(events: DataFrame) -> DataFrame:
    """The history text of an event summary."""
    return events.select("person_id", "imms_history")


def non_attendance_text(non_attendance: DataFrame) -> DataFrame:
    """One missed-appointment text per person (the smallest if several)."""
    return non_attendance.groupBy("person_id").agg(F.min("dna_text").alias("dna_since_immunised"))


def suspension_text(suspensions: DataFrame) -> DataFrame:
    """Active suspensions (no end, or ending after the record date) with a
    counting reason: '<vaccines>: <reasons> from <dates>', or just
    '<reasons> from <dates>' while waiting for records. Dates dd/MM/yyyy in
    date order."""
    s = suspensions.where(f"(end_date > va_date OR end_date IS NULL) AND {_counts('reason_code', C.SUSPENSION_REASONS)}")
    dates = "array_sort(collect_set(start_date))"
    date_text = F.expr(f"CASE WHEN size({dates}) > 0 THEN array_join(transform({dates}, "
                       f"d -> date_format(d, 'dd/MM/yyyy')), ', ') END")
    agg = (s.groupBy("person_id")
           .agg(distinct_list("vaccine").alias("_vaccines"),
                distinct_list("reason_desc").alias("_descs"),
                date_text.alias("_dates"))
           .where("_vaccines IS NOT NULL"))
    waiting = sql_lit(C.SUSPENSION_WAITING_PREFIX.upper() + "%")
    return agg.selectExpr("person_id", f"""CASE WHEN upper(_descs) LIKE {waiting}
        THEN concat(_descs, ' from ', _dates)
        ELSE concat(_vaccines, ': ', _descs, ' from ', _dates) END AS suspended""")


def text_summaries(report: DataFrame, consents: DataFrame, events: DataFrame,
                   non_attendance: DataFrame, suspensions: DataFrame) -> DataFrame:
    """Left-join the four per-person texts onto the report; ``events`` is the event summary
    or the history texts of it."""
    out = report
    for df in (negative_consent_text(consents), event_history_text(events),
               non_attendance_text(non_attendance), suspension_text(suspensions)):
        d = df.withColumnRenamed("person_id", "_tp")
        out = out.join(d, out.person_id == d._tp, "left").drop("_tp")
    return out
