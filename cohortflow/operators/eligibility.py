"""Who is due what, and how many valid events each due rule has.

Scale notes
-----------
* People are dealt by person once, before they are expanded; the expansion, the
  counting join and all that follows up to the antigen overrides stay in place.
* A rule is due for an interval of dates of birth. The ends of all intervals cut
  the calendar into at most 2 x rules + 1 segments with one set of due rules
  each; a date of birth finds its segment by an as-of join over sorted dates. So
  people meet two broadcast frames, dates of birth (bounded by the calendar) and
  segments (bounded by ``Policy.max_rules``), and no rule is compared with a date.
* Events are reduced to one row per (person, antigen, dose, day), where they are if they
  are stored by person, else with map-side combine; from then on they stay dealt by person.
* Expanded rows and event days are joined by person alone, so neither is dealt again, also
  in a session that wants all join keys in a partitioning.
* A window is counted as the difference of two running counts, each found by
  binary search: no row for each pair of rule and event day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions.dates import add_steps_sql, age_steps, latest_birth_sql, sql_lit
from cohortflow.functions.text import replace_all

# Rule columns carried by the expansion.
EXPANDED_RULE_COLUMNS = [
    "rule_ref", "prev_ref", "product", "stage", "antigen", "doses_required",
    "count_from_value", "count_from_unit", "count_to_value", "count_to_unit",
    "due_from_unit", "due_from_value", "due_to_unit", "due_to_value",
]
COUNT_KEYS = ["person_id", "dob", "rule_ref", "prev_ref", "antigen", "product", "stage",
              "doses_required", "va_date"]


def normalise_antigen(code, policy: C.Policy = C.DEFAULT_POLICY) -> F.Column:
    """Alias antigen codes (MENW->ACWY, CPOX->VAR) and cut them to the policy's length."""
    return F.substring(replace_all(code, C.ANTIGEN_ALIASES), 1, policy.antigen_code_length)


def clean_event_days(events_by_antigen: DataFrame, events_by_product: DataFrame,
                     policy: C.Policy = C.DEFAULT_POLICY, combine: bool = True) -> DataFrame:
    """Events per (person, antigen code, dose, day) with their number, minus doses that belong to
    a booster product coded as primary. Without ``combine`` each event stays a row of its own, for
    events that are stored by person: there is no exchange that fewer rows would make smaller.

    An antigen dose is dropped when the same person has a booster-product event on the same day
    whose part equals the antigen dose, the antigen is one of the booster components and the dose
    is a primary dose ('...P'). One pass over the events; the result is dealt by person, and
    events stored by person are not dealt again for it.
    """
    keys = ["person_id", "antigen_code", "antigen_dose", "event_date"]
    days = (events_by_antigen.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_events")) if combine
            else events_by_antigen.select(*keys, F.lit(1).cast("long").alias("n_events")))
    # a person's booster doses are one row (at most one entry a day and dose), so the join is by
    # person alone and stays on the partitioning of the days
    boosters = (events_by_product
                .where((F.col("vaccine_code") == C.BOOSTER_PRODUCT_CODE) & F.col("event_date").isNotNull())
                .groupBy(F.col("person_id").alias("b_person"))
                .agg(F.collect_set(F.struct("event_date", F.col("vaccine_part").alias("antigen_dose"))).alias("boosted")))
    claimed = (F.col("antigen_code").isin(*C.BOOSTER_EXCLUDED_ANTIGENS)
               & F.col("antigen_dose").endswith(C.PRIMARY_DOSE_SUFFIX)
               & F.array_contains("boosted", F.struct("event_date", "antigen_dose")))
    kept = (days.join(boosters, days.person_id == boosters.b_person, "left")
            .where(~F.coalesce(claimed, F.lit(False))).select(*days.columns))
    return kept.withColumn("antigen_norm", normalise_antigen(F.col("antigen_code"), policy))


def clean_events(event_days: DataFrame) -> DataFrame:
    """The rows of :func:`clean_event_days` one by one."""
    return (event_days.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), "n_events")))
            .drop("_n", "n_events"))


def event_counts(event_days: DataFrame) -> DataFrame:
    """(person, antigen, date, number of events), on the partitioning of the days. A day has a row for
    each code and dose; `running_counts` adds them up, as it has to sort them anyway."""
    return event_days.select("person_id", "antigen_norm", "event_date", "n_events")


def in_scope_people(population: DataFrame, as_of: dt.date,
                    policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """(person, dob, va_date) of people at least ``min_population_age_months`` old."""
    return (population.select("person_id", "dob", "va_date")
            .where(F.col("dob") <= F.add_months(F.lit(as_of), -policy.min_population_age_months)))


def numbered_rules(rules: DataFrame) -> DataFrame:
    """The distinct rules with a number each. One task, bounded by ``Policy.max_rules``: all that is
    derived from the rules alone then needs no exchange."""
    r = rules.coalesce(1).select(*EXPANDED_RULE_COLUMNS, "valid_from", "valid_to").distinct()
    return r.withColumn("rule_no", F.row_number().over(Window.orderBy(*r.columns)))


def rule_spans(rules: DataFrame, as_of: dt.date) -> DataFrame:
    """(rule_no, first, after): the dates of birth for which a rule is due on ``as_of``, from
    ``first`` up to the day before ``after``; rules that are due for nobody are left out."""
    a = sql_lit(as_of)
    latest = latest_birth_sql(as_of, "due_from_value", "due_from_unit")
    spans = rules.selectExpr("rule_no", "valid_from AS first", f"coalesce(valid_to, {a}) AS last", f"{latest} AS latest")
    return (spans.where("first IS NOT NULL AND latest IS NOT NULL")
            .selectExpr("rule_no", "first", "date_add(least(last, latest), 1) AS after").where("first < after"))


def due_segments(spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The calendar cut where a set of due rules begins or ends.

    The first frame has (segment, begin), segments numbered from 1 in date order and each ending
    where the next begins; the second has (segment, due), the numbers of the rules due there.
    """
    ends = spans.select(F.col("first").alias("begin")).union(spans.select("after")).distinct()
    begins = ends.withColumn("segment", F.row_number().over(Window.orderBy("begin")))
    first = begins.selectExpr("begin AS first", "segment AS i")
    after = begins.selectExpr("begin AS after", "segment AS j")
    covered = (spans.join(first, "first").join(after, "after")
               .selectExpr("rule_no", "explode(sequence(i, j - 1)) AS segment"))
    return begins, covered.groupBy("segment").agg(F.collect_list("rule_no").alias("due"))


def segment_of_births(people: DataFrame, begins: DataFrame) -> DataFrame:
    """(dob, segment): an as-of join of the distinct dates of birth with the segments' begins, as one
    running value over the sorted dates (one task, bounded by the calendar and the rules)."""
    days = (begins.select(F.col("begin").alias("dob"), "segment", F.lit(0).alias("birth"))
            .union(people.select("dob").distinct().withColumns({"segment": F.lit(None).cast("int"), "birth": F.lit(1)})))
    so_far = Window.orderBy("dob", "birth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (days.withColumn("segment", F.last("segment", ignorenulls=True).over(so_far))
            .where("birth = 1 AND dob IS NOT NULL AND segment IS NOT NULL").select("dob", "segment"))


def expand_rules(population: DataFrame, rules: DataFrame, as_of: dt.date,
                 policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """Each person joined to every rule that is due on ``as_of``.

    A rule is due when the date of birth lies in its validity range and its due-from age is
    reached; its counting window is resolved to dates. People with no due rule keep one row with
    NULL rule columns. Only people at least ``min_population_age_months`` old are in scope. The
    result is dealt by person.
    """
    people = in_scope_people(population, as_of, policy)
    numbered = numbered_rules(rules)
    begins, due = due_segments(rule_spans(numbered, as_of))
    steps = [*age_steps("_from", "count_from_value", "count_from_unit"), *age_steps("_to", "count_to_value", "count_to_unit")]
    windows = [f"{add_steps_sql('dob', '_from')} AS window_start", f"{add_steps_sql('dob', '_to')} AS window_end"]
    # broadcast: at most a row a calendar day; a row a segment; a row a rule
    return (people.repartition("person_id").distinct()
            .join(F.broadcast(segment_of_births(people, begins)), "dob", "left")
            .join(F.broadcast(due), "segment", "left")
            .selectExpr("person_id", "dob", "va_date", "explode_outer(due) AS rule_no")
            .join(F.broadcast(numbered.selectExpr("rule_no", *EXPANDED_RULE_COLUMNS, *steps)), "rule_no", "left")
            .selectExpr("person_id", "dob", *EXPANDED_RULE_COLUMNS, *windows, "va_date"))


def running_counts(counts: DataFrame) -> DataFrame:
    """One row per (person, antigen): the days with events in order, each with the number of events
    up to and including it (at most one entry a calendar day), and the steps of a binary search."""
    by_day = Window.partitionBy("person_id", "antigen_norm").orderBy("event_date")
    upto = F.sum("n_events").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = (counts.where("event_date IS NOT NULL").withColumns({"upto": upto, "next_day": F.lead("event_date").over(by_day)})
            .where("NOT next_day <=> event_date"))
    # the list is a window over the order that the running counts have, kept on the last day's row: an
    # aggregate would sort the rows once more. Each day's row holds the list until then, which grows with
    # the square of the days of one person and antigen (at most the calendar)
    days = F.collect_list(F.struct(F.col("event_date").alias("day"), "upto")).over(by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (ends.withColumn("days", days).where("next_day IS NULL").select("person_id", "antigen_norm", "days")
            .withColumn("steps", F.expr("transform(sequence(CAST(floor(log2(size(days))) AS INT), 0), i -> shiftleft(1, i))")))


def events_before_sql(limit: str, inclusive: bool) -> str:
    """Number of events up to the date ``limit`` by binary search in ``days`` (`running_counts`)."""
    place = (f"aggregate(steps, 0, (at, step) -> IF(at + step <= size(days) AND days[at + step - 1].day "
             f"{'<=' if inclusive else '<'} {limit}, at + step, at))")
    return f"coalesce(element_at(days, nullif({place}, 0)).upto, 0)"


def has_alike_rules(rules: DataFrame) -> bool:
    """Whether rules differ only in what :func:`count_in_window` sums over (ages, dates of birth). It
    reads the rule table, bounded by ``Policy.max_rules``."""
    numbered = numbered_rules(rules)
    return not numbered.groupBy(*[c for c in COUNT_KEYS if c in EXPANDED_RULE_COLUMNS]).count().where("count > 1").isEmpty()


def count_in_window(expanded: DataFrame, counts: DataFrame, alike: bool = True) -> DataFrame:
    """Number of valid events inside each due rule's counting window (D3).

    ``alike``: rows of ``expanded`` may agree in all but their windows and are then summed; without
    such rows (`has_alike_rules`) there is nothing to group.

    An equi-join with one row per (person, antigen), so a rule meets one row however many event
    days there are; the count is a difference of two running counts.
    """
    ev = running_counts(counts).withColumnRenamed("person_id", "e_person")
    n = (f"CASE WHEN days IS NULL OR window_start IS NULL OR window_end IS NULL OR window_start > window_end THEN 0 "
         f"ELSE {events_before_sql('window_end', True)} - {events_before_sql('window_start', False)} END")
    # joined by person alone, on which both sides are dealt; the antigens are compared as a bound from
    # above and below, as an equality would be taken for a second key and both sides dealt again by it
    same_antigen = (expanded.antigen >= ev.antigen_norm) & (expanded.antigen <= ev.antigen_norm)
    counted = expanded.join(ev, (expanded.person_id == ev.e_person) & same_antigen, "left").withColumn("_n", F.expr(n))
    if not alike:
        return counted.select(*COUNT_KEYS, F.col("_n").cast("int").alias("valid_doses_given"))
    return counted.groupBy(*COUNT_KEYS).agg(F.sum("_n").cast("int").alias("valid_doses_given"))
