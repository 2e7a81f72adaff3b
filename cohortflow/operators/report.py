"""The wide per-person report.

The report is keyed and partitioned by person. Person-sized inputs
(demographics, population) are joined on person after de-duplication on the
key. Reference dimensions are de-duplicated; the pipeline stores them and hints a
broadcast where their stored size allows, so the wide rows stay where they are.
Else they are shuffled, with the rows of hot keys dealt to many tasks (``skew``).
Rows without a key are spread over all tasks instead of meeting in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import config as C
from cohortflow.functions import dates as D
from cohortflow.functions.dates import sql_lit
from cohortflow.operators.skew import salted_left_join
from cohortflow.operators.status import pivot_column


def q(name: str) -> str:
    """Back-quoted column name for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def cell_sql(given: str, state: str) -> str:
    """'given.state' with NULL parts left blank; NULL when both parts are NULL."""
    return (f"CASE WHEN {given} IS NULL AND {state} IS NULL THEN NULL ELSE concat("
            f"coalesce(CAST({given} AS STRING), ''), '.', coalesce(CAST({state} AS STRING), '')) END")


def report_core(pivots: DataFrame, products: list[str]) -> DataFrame:
    """One text cell per product of the doses given and the state (``status.pivot_all``).

    The cells are one list, made by one expression for all products: a text expression for each makes a
    generated method that grows with the products, and above 8,000 bytes the JVM does not compile it.
    """
    given, state = ("array(" + ", ".join(q(pivot_column(p, v)) for p in products) + ")" for v in ("doses_given", "state"))
    cells = pivots.selectExpr("person_id", f"zip_with({given}, {state}, (g, s) -> {cell_sql('g', 's')}) AS _cells")
    return cells.selectExpr("person_id", *[f"get(_cells, {i}) AS {q(p)}" for i, p in enumerate(products)])


def dedupe_on(df: DataFrame, key: str) -> DataFrame:
    """One deterministic row per key (the smallest row), so a join cannot fan out."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    return (df.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.min(F.struct(*others)).alias("_r"))
            .select(key, "_r.*"))


def _spread(key: str) -> F.Column:
    """A join key whose missing values differ from row to row and match nothing."""
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000none"), F.col("person_id").cast("string")))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.selectExpr(*[f"{q(c)} AS {q(prefix + c)}" for c in df.columns])


def demographics_star(core: DataFrame, population: DataFrame, demographics: DataFrame,
                      gp: DataFrame, la: DataFrame, postcodes: DataFrame, deprivation: DataFrame,
                      schools: DataFrame, policy: C.Policy = C.DEFAULT_POLICY,
                      unique: bool = False, hot: dict[str, DataFrame] | None = None) -> DataFrame:
    """Demographic, registration, residence, deprivation and age columns from
    two person sources (population register 'pd', local record 'dd'). ``unique``: the reference
    tables have one row a key already, perhaps with a broadcast hint. ``hot``: for each key column of
    the two sources whose table is shuffled, its hot keys."""
    def look(rows: DataFrame, table: DataFrame, table_key: str, key: str) -> DataFrame:
        if hot and key in hot:
            return salted_left_join(rows, table, _spread(key), table_key, hot[key], "person_id")
        return rows.join(table, F.col(table_key) == _spread(key), "left")

    a = sql_lit(policy.as_of)
    pd_ = _prefixed(dedupe_on(population, "person_id"), "pd_")
    dd = _prefixed(dedupe_on(demographics, "person_id"), "dd_")
    if not unique:
        gp, la = dedupe_on(gp, "practice_code"), dedupe_on(la, "la_code")
        postcodes, deprivation = dedupe_on(postcodes, "postcode"), dedupe_on(deprivation, "lsoa")
        schools = dedupe_on(schools, "school_code")
    gp_pd, gp_dd = _prefixed(gp, "gp_"), _prefixed(gp, "gpc_")
    la_pd, la_dd = _prefixed(la, "la_"), _prefixed(la, "lac_")
    ons_pd, ons_dd = _prefixed(postcodes, "ons_"), _prefixed(postcodes, "onsc_")
    imd_pd, imd_dd = _prefixed(deprivation, "imd_"), _prefixed(deprivation, "imdc_")
    sch = _prefixed(schools, "sch_")

    j = (core.join(dd, core.person_id == dd.dd_person_id, "left")
         .join(pd_, core.person_id == pd_.pd_person_id, "left"))
    for table, table_key, key in (
            (gp_pd, "gp_practice_code", "pd_gp_code"), (gp_dd, "gpc_practice_code", "dd_practice_code"),
            (la_dd, "lac_la_code", "dd_la_code"), (la_pd, "la_la_code", "pd_la_code"),
            (ons_pd, "ons_postcode", "pd_postcode"), (imd_pd, "imd_lsoa", "ons_lsoa"),
            (ons_dd, "onsc_postcode", "dd_postcode"), (imd_dd, "imdc_lsoa", "onsc_lsoa"),
            (sch, "sch_school_code", "dd_school_code")):
        j = look(j, table, table_key, key)

    years = D.age_in_years_sql("pd_dob", a)
    grp = f"coalesce({years}, try_cast(dd_age_text AS INT))"
    (lo, young), (hi, mid), (_, old) = C.AGE_GROUPS
    group = (f"CASE WHEN {grp} < {lo} THEN {sql_lit(young)} WHEN {grp} >= {lo} AND {grp} < {hi} "
             f"THEN {sql_lit(mid)} ELSE {sql_lit(old)} END")

    def cover(label: str) -> str:
        return "CASE " + " ".join(f"WHEN dd_{c} = {label} THEN {sql_lit(n)}"
                                  for c, n in C.COVER_COHORTS) + " END"

    def matched(key: str) -> str:
        return f"CASE WHEN {key} IS NOT NULL THEN 1 ELSE 0 END"

    def locality(key: str, hub: str) -> str:
        h = hub
        for src, dst in C.LOCALITY_RENAMES:
            h = f"replace({h}, {sql_lit(src)}, {sql_lit(dst)})"
        return f"CASE WHEN {key} IS NOT NULL THEN {h} END"

    la_out, ccg_out = sql_lit(C.OUT_OF_AREA_LA), sql_lit(C.OUT_OF_AREA_CCG)
    products = [c for c in core.columns if c != "person_id"]
    return j.selectExpr(
        "person_id", "dd_local_id AS local_id", "pd_forename AS forename", "pd_surname AS surname",
        "pd_gender AS gender", "pd_dob AS date_of_birth",
        f"{cover(D.fin_quarter_label_sql(a))} AS current_cover",
        f"{cover(D.fin_quarter_label_sql(f'add_months({a}, 3)'))} AS next_quarter_cover",
        "pd_postcode AS postcode", "ons_ward_code AS ward_code", "ons_ward_name AS ward_name",
        "dd_contact_numbers AS contact_numbers", "ons_lsoa AS lsoa", "imd_imd_decile AS imd_decile",
        "pd_gp_code AS practice_code", "gp_practice_name AS practice_name",
        f"{matched('gp_practice_code')} AS registered_in_area",
        f"{locality('gp_practice_code', 'gp_hub')} AS registered_locality",
        "pd_ccg_code AS ccg_code", "gp_ccg_description AS ccg_name", "gp_pcn_code AS pcn_code",
        "gp_pcn_name AS pcn_name", "pd_la_code AS la_code",
        f"coalesce(la_la_name, {la_out}) AS la_name",
        f"{matched('la_la_code')} AS resident_in_area",
        f"{locality('la_la_code', 'la_hub')} AS resident_locality",
        "dd_school_code AS school_code", "dd_school_name AS school_name",
        "dd_school_in_area AS school_in_area", "sch_contract AS school_contract",
        f"{D.age_in_months_sql('pd_dob', a)} AS age_in_months",
        f"{years} AS age_in_years",
        f"{D.full_age_sql('pd_dob', a)} AS full_age",
        f"{group} AS age_group",
        "dd_ethnic_code AS ethnic_code", "dd_ethnic_description AS ethnic_description",
        *[q(p) for p in products],
        "dd_forename AS forename_local", "dd_surname AS surname_local", "dd_sex AS gender_local",
        "dd_dob AS date_of_birth_local", "dd_practice_code AS practice_code_local",
        "dd_practice_name AS practice_name_local",
        f"{matched('gpc_practice_code')} AS registered_in_area_local",
        f"{locality('gpc_practice_code', 'gpc_hub')} AS registered_locality_local",
        "dd_ccg_code AS ccg_code_local",
        f"coalesce(gpc_ccg_description, {ccg_out}) AS ccg_name_local",
        "gpc_pcn_code AS pcn_code_local", "gpc_pcn_name AS pcn_name_local",
        "dd_postcode AS postcode_local", "onsc_ward_code AS ward_code_local",
        "onsc_ward_name AS ward_name_local", "onsc_lsoa AS lsoa_local",
        "imdc_imd_decile AS imd_decile_local", "dd_la_code AS la_code_local",
        f"coalesce(lac_la_name, {la_out}) AS la_name_local",
        f"{matched('lac_la_code')} AS resident_in_area_local",
        f"{locality('lac_la_code', 'lac_hub')} AS resident_locality_local",
        "dd_va_date AS va_date",
    )


def name_repair(report: DataFrame, ccg: DataFrame, policy: C.Policy = C.DEFAULT_POLICY, unique: bool = False) -> DataFrame:
    """Where a CCG code is present but its name is missing, look the
    name up in the CCG dimension, falling back to 'Out of Area CCG'."""
    d = _prefixed(ccg if unique else dedupe_on(ccg, "ccg_code"), "ccgd_")
    j = report.join(d, d.ccgd_ccg_code == _spread("ccg_code"), "left")
    return j.withColumn("ccg_name", F.expr(
        f"CASE WHEN ccg_code IS NOT NULL AND ccg_name IS NULL "
        f"THEN coalesce(ccgd_ccg_name, {sql_lit(C.OUT_OF_AREA_CCG)}) ELSE ccg_name END")
    ).drop(*d.columns)


def _tsql_int(s: str) -> str:
    """Text to int where '' counts as 0 and anything unparsable is NULL."""
    return f"(CASE WHEN {s} = '' THEN 0 ELSE try_cast({s} AS INT) END)"


def combine_cells_sql(a: str, b: str) -> str:
    """Merge two 'given.state' cells: one side NULL -> the other; otherwise
    given = sum of the leading numbers and state = the smaller state digit
    (the second side's when the first is not a digit)."""
    la, lb = _tsql_int(f"substring_index({a}, '.', 1)"), _tsql_int(f"substring_index({b}, '.', 1)")
    ra, rb = f"try_cast(right({a}, 1) AS INT)", f"try_cast(right({b}, 1) AS INT)"
    state = f"CASE WHEN {ra} < {rb} THEN {ra} ELSE {rb} END"
    return (f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN NULL WHEN {a} IS NULL THEN {b} "
            f"WHEN {b} IS NULL THEN {a} ELSE concat(CAST({la} + {lb} AS STRING), '.', "
            f"CAST({state} AS STRING)) END")


def combined_columns(report: DataFrame) -> DataFrame:
    """The 'any MMR' columns from the MMR and MMRV product cells."""
    def col_or_null(name: str) -> str:
        return q(name) if name in report.columns else "CAST(NULL AS STRING)"

    pairs = ((C.PRODUCT_MMR_ANY_1, C.PRODUCT_MMR_1, C.PRODUCT_MMRV_1),
             (C.PRODUCT_MMR_ANY_2, C.PRODUCT_MMR_2, C.PRODUCT_MMRV_2))
    return report.withColumns({out: F.expr(combine_cells_sql(col_or_null(x), col_or_null(y)))
                               for out, x, y in pairs})


def hpv_boys_sql(policy: C.Policy = C.DEFAULT_POLICY) -> str:
    """Boys born before the HPV programme cut-off (report gender/dob)."""
    return f"(gender = 'M' AND date_of_birth < {sql_lit(policy.hpv_boys_born_before)})"


def hpv_waiver(status: DataFrame, report: DataFrame, policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """HPV is not needed for the boys of :func:`hpv_boys_sql` (status rows)."""
    boys = report.where(hpv_boys_sql(policy)).selectExpr("person_id AS b_person").distinct()
    j = status.join(boys, status.person_id == boys.b_person, "left")
    return j.withColumn("still_needed", F.expr(
        f"CASE WHEN product = {sql_lit(C.PRODUCT_HPV)} AND b_person IS NOT NULL THEN 0 "
        f"ELSE still_needed END")).drop("b_person")


def hpv_proxy(report: DataFrame, policy: C.Policy = C.DEFAULT_POLICY) -> DataFrame:
    """For those boys the HPV cell becomes '<doses>.4', or NULL for no dose."""
    if C.PRODUCT_HPV not in report.columns:
        return report
    h = q(C.PRODUCT_HPV)
    return report.withColumn(C.PRODUCT_HPV, F.expr(
        f"CASE WHEN coalesce({hpv_boys_sql(policy)} AND {h} IS NOT NULL, FALSE) THEN "
        f"(CASE WHEN left({h}, 1) = '0' THEN NULL ELSE concat(left({h}, 1), "
        f"{sql_lit(C.HPV_PROXY_SUFFIX)}) END) ELSE {h} END"))


def outstanding_list(report: DataFrame, products: list[str]) -> DataFrame:
    """D20 (O39, O41): products whose state is 0, in product order, joined by ', '.

    When an MMR product is listed, MMR-n is reported as MMRV-n and repeats are
    removed. A single blank means nothing is outstanding.
    """
    items = "filter(array(" + ", ".join(
        f"CASE WHEN right({q(p)}, 1) = '0' THEN {sql_lit(p)} END" for p in products) + \
        "), x -> x IS NOT NULL)"
    renamed = (f"array_distinct(transform({items}, x -> replace(replace(x, "
               f"{sql_lit(C.PRODUCT_MMR_1)}, {sql_lit(C.PRODUCT_MMRV_1)}), "
               f"{sql_lit(C.PRODUCT_MMR_2)}, {sql_lit(C.PRODUCT_MMRV_2)})))")
    listed = f"CASE WHEN exists({items}, x -> x LIKE '%MMR-%') THEN {renamed} ELSE {items} END"
    return report.withColumn("outstanding_imms", F.expr(
        f"CASE WHEN size({listed}) = 0 THEN ' ' ELSE array_join({listed}, ', ') END"))


def previous_report_flag(report: DataFrame, previous: DataFrame) -> DataFrame:
    """1 when the person was on the previous report, else NULL."""
    prev = previous.selectExpr("person_id AS h_person").distinct()
    return (report.join(prev, report.person_id == prev.h_person, "left")
            .withColumn("on_previous_report", F.expr("CASE WHEN h_person IS NOT NULL THEN 1 END"))
            .drop("h_person"))
