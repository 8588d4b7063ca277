"""The whole path at once: raw tables, a cohort of some hundred patients, its research dataset, statistics on it.

The exclusion is looked for in observations, outcomes have rare codes, and patients of several classes stay in.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cohort, outcome
from ..operators.sets import union_lists
from ..sources.layout import write_bucketed
from ..sources.tables import materialise
from ..stats import association, balance, describe, tmle
from .cohorts import (
    BASE, CENSORED, COHORT_COLUMNS, COVARIATES, EARLIEST, LAST, RESEARCH, SINGLE, STUDY_ENDS, VERY_FIRST, _STEPS, _attrition_sql, coded_sql,
    cohort_sql, covariates, of_study, step_rows_sql,
)
from .registry import query
from .statistics import COUNTS, PAIR_COUNTS, PAIRED, SHARES, SPREAD, WELCH, _chi_sql, _long, _quantiles_sql, chi2_p_sql, rounded, t_p_sql
from .views import ACCEPTED, BANDS, CONVERT, RARE_CODE, SQL_VIEWS, STUDY_END, STUDY_START, TARGET, Views

LARGEST, BUCKETS = 3, 8
NOT_EXCLUDED = """NOT EXISTS (SELECT 1 FROM observation d WHERE d.medcodeid = 'excluded' AND d.patid = e.patid
    AND coalesce(d.obsdate, d.enterdate) > e.study_entry_date)"""
VIEWS = {
    "observation": SQL_VIEWS["observation"].replace("p_brand AS medcodeid", f"{RARE_CODE} AS medcodeid"),
    "exposure_codes": f"SELECT p_partkey AS code, p_type AS term FROM part WHERE p_size <= {LARGEST}",
}
FULL = {
    **VIEWS, **BASE, "coded": coded_sql("('measured')", "('moderate')", "('severe')"), "earliest": EARLIEST, "very_first": VERY_FIRST,
    "single": SINGLE, "cohort": cohort_sql(NOT_EXCLUDED, "TRUE"),
}
ENDED = {**FULL, "lasts": LAST, "study_ends": STUDY_ENDS, "censored": CENSORED}


def whole_study(v: Views) -> cohort.Study:
    rules = outcome.OutcomeRules(
        *[v.rare_list(n, code) for n, code in (("ck", "measured"), ("myopathy", "moderate"), ("rhabdo", "severe"))],
        bands=BANDS, accepted=ACCEPTED, convert=CONVERT, target=TARGET,
    )
    exposure = v._drug_list("exposure", f"p_size <= {LARGEST}")
    return cohort.Study(exposure, STUDY_START, STUDY_END, exclusion=v.rare_list("exclusion", "excluded"), outcome=rules, single_class=False)


def kept(v: Views) -> DataFrame:
    s = whole_study(v)
    return cohort.acceptable_cohort(v.patient, v.drug_issue, of_study(v, s).rare_observation, s)


@query("whole_cohort", "SELECT * REPLACE (CAST(outcome AS INTEGER) AS outcome) FROM cohort", **FULL)
def _(v: Views):
    return kept(v).select(*COHORT_COLUMNS)


@query("whole_attrition", _attrition_sql([n for n, _ in _STEPS if n != "single_class"]), **FULL, steps=step_rows_sql(NOT_EXCLUDED))
def _(v: Views):
    s = whole_study(v)
    return cohort.cohort_attrition(v.patient, v.drug_issue, of_study(v, s).rare_observation, s)


@query("whole_restricted", """SELECT 'drug' AS kind, patid, CAST(prodcodeid AS VARCHAR) AS code, coalesce(issuedate, enterdate) AS on_day FROM drug_issue WHERE patid IN (SELECT patid FROM cohort)
    UNION ALL SELECT 'observation', patid, medcodeid, coalesce(obsdate, enterdate) FROM observation WHERE patid IN (SELECT patid FROM cohort)""", **FULL)
def _(v: Views):
    patients = materialise(kept(v).select("patid"))
    own = v.of_patients(patients)
    drugs, seen = cohort.restrict_events(patients, own.drug_issue, own.rare_observation)
    return union_lists([
        drugs.selectExpr("'drug' AS kind", "patid", "CAST(prodcodeid AS STRING) AS code", "coalesce(issuedate, enterdate) AS on_day"),
        seen.selectExpr("'observation' AS kind", "patid", "medcodeid AS code", "coalesce(obsdate, enterdate) AS on_day"),
    ])


@query("whole_research", RESEARCH, **ENDED, **COVARIATES)
def research(v: Views):
    s, c = whole_study(v), covariates(v)
    return cohort.research_dataset(v.patient, v.drug_issue, of_study(v, s, c).rare_observation, s, c)


@query("whole_research_bucketed", RESEARCH, **ENDED, **COVARIATES)
def research_bucketed(v: Views):
    """The same on tables that are stored in buckets of the patient."""
    patients, drugs, seen = (write_bucketed(t, "patid", BUCKETS) for t in (v.patient, v.drug_issue, v.rare_observation))
    return cohort.research_dataset(patients, drugs, seen, whole_study(v), covariates(v))


@query("whole_research_early", RESEARCH, **ENDED, **COVARIATES)
def research_early(v: Views):
    """The same with drugs and observations reduced to the patients that exposure leaves eligible, before their tables meet."""
    s, c = whole_study(v), covariates(v)
    exposed = cohort.eligibility(v.patient, v.drug_issue, None, replace(s, exclusion=None, outcome=None))
    patients = materialise(cohort.keep_eligible(exposed, s, events_known=False).select(*v.patient.columns))
    own = v.of_patients(patients.select("patid"))
    return cohort.research_dataset(patients, own.drug_issue, of_study(own, s, c).rare_observation, s, c, early=True)


# Complete cases, compared by treatment.
NUMBERS, CATEGORIES = ("age_at_exposure", "BMI"), ("gender", "Ethnic", "asthma")
_WANTED = ("patid", "outcome", "treatment", *NUMBERS, *CATEGORIES)
CASES = {
    **ENDED, **COVARIATES, "research": RESEARCH,
    "cases": "SELECT *, CAST(treatment AS VARCHAR) AS grp FROM research WHERE " + " AND ".join(f'"{c}" IS NOT NULL' for c in _WANTED),
    "numbers": _long("cases", NUMBERS, "DOUBLE"), "spread": SPREAD, "paired": PAIRED, "levels": _long("cases", CATEGORIES, "VARCHAR"),
    "counts": COUNTS, "shares": SHARES,
}


def cases(v: Views) -> DataFrame:
    rows = research(v).select(*_WANTED).dropna().withColumn("grp", F.col("treatment").cast("string"))
    return materialise(rows.withColumns({c: F.col(c).cast("double") for c in NUMBERS} | {c: F.col(c).cast("string") for c in CATEGORIES}))


CASE_TABLE = """SELECT variable, level, grp, overall, CAST(n AS BIGINT) AS n, round(n * 100.0 / sum(n) OVER (PARTITION BY variable, grp, overall), 6) AS percent, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS sd, CAST(0 AS BIGINT) AS missing
    FROM (SELECT variable, level, grp, n, FALSE AS overall FROM counts UNION ALL SELECT variable, level, 'Overall', sum(n), TRUE FROM counts GROUP BY 1, 2)
    UNION ALL SELECT variable, NULL, grp, overall, count(*), NULL, round(avg(x), 6), round(stddev_samp(x), 6), 0 FROM (SELECT grp, variable, x, FALSE AS overall FROM numbers UNION ALL SELECT 'Overall', variable, x, TRUE FROM numbers) GROUP BY 1, 3, 4"""


@query("case_table_one", CASE_TABLE, **CASES)
def _(v: Views):
    return rounded(balance.table_one(cases(v), "grp", CATEGORIES, NUMBERS), "percent", "mean", "sd")


@query("case_smd_numeric", "SELECT variable, group1, group2, round(abs(m1 - m2) / sqrt((s1 + s2) / 2), 6) AS smd FROM paired", **CASES)
def _(v: Views):
    return rounded(balance.smd_numeric(cases(v), "grp", NUMBERS), "smd")


@query("case_smd_categorical", "SELECT variable, level, group1, group2, CASE WHEN p1 * (1 - p1) + p2 * (1 - p2) > 0 THEN round(abs(p1 - p2) / sqrt((p1 * (1 - p1) + p2 * (1 - p2)) / 2), 6) END AS smd FROM shares", **CASES)
def _(v: Views):
    return rounded(balance.smd_categorical(cases(v), "grp", CATEGORIES), "smd")


@query(
    "case_chi_square", f"SELECT variable, group1, group2, round(statistic, 6) AS statistic, dof, {chi2_p_sql('statistic', 'dof')} AS p_value FROM tested",
    **CASES, pair_counts=PAIR_COUNTS, tested=_chi_sql("pair_counts", "variable, group1, group2"),
)
def _(v: Views):
    return rounded(association.chi_square_pairs(cases(v), "grp", CATEGORIES), "statistic", "p_value")


@query("case_welch_t", f"SELECT variable, group1, group2, round(statistic, 6) AS statistic, round(dof, 4) AS dof, {t_p_sql('statistic', 'dof')} AS p_value FROM welch", **CASES, welch=WELCH)
def _(v: Views):
    return rounded(rounded(association.welch_t_pairs(cases(v), "grp", NUMBERS), "statistic", "p_value"), "dof", digits=4)


@query("case_box_summary", _quantiles_sql("grp"), **CASES)
def _(v: Views):
    return rounded(describe.box_summary(cases(v), NUMBERS, "grp"), "low", "q1", "median", "q3", "high")


# With one two-valued covariate the targeted estimate is the share standardised over its values.
CASE_EFFECT = """SELECT 'risk difference' AS estimand, round(p1 - p0, 5) AS estimate, n FROM standard
    UNION ALL SELECT 'relative risk', round(p1 / p0, 5), n FROM standard
    UNION ALL SELECT 'odds ratio', round(p1 * (1 - p0) / (p0 * (1 - p1)), 5), n FROM standard"""
CASE_STANDARD = """SELECT sum(n * p1) / sum(n) AS p1, sum(n * p0) / sum(n) AS p0, CAST(sum(n) AS BIGINT) AS n FROM (SELECT gender, count(*) AS n,
    avg(CASE WHEN treatment = 2 THEN CAST(age_at_exposure >= 40 AS INTEGER) END) AS p1, avg(CASE WHEN treatment = 1 THEN CAST(age_at_exposure >= 40 AS INTEGER) END) AS p0
    FROM cases WHERE treatment IN (1, 2) GROUP BY 1)"""


@query("case_tmle", CASE_EFFECT, **CASES, standard=CASE_STANDARD)
def _(v: Views):
    """Two of the five treatments; the outcome stands in for a rarer one: an age of 40 or more."""
    rows = cases(v).selectExpr("CAST(age_at_exposure >= 40 AS INT) AS y", "treatment", "gender")
    result = tmle.tmle_binary(rows, "y", "treatment", categorical=["gender"], treatments=(1, 2))
    return rounded(result.select("estimand", "estimate", "n"), "estimate", digits=5)
