"""Queries on exposure, eligibility, outcome, covariates, treatment patterns and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cohort, events, exposure, flags, joins, outcome, patterns, rollup
from ..operators.sets import union_lists
from ..sources.codelists import long_codelist
from ..sources.tables import flatten_arrays_for_csv
from .basics import EXPOSED, FIRST
from .registry import query
from .views import (
    ACCEPTED, BANDS, CONDITIONS, CONVERT, EVENT_TYPES, MEASURE_HIGH, MEASURE_LOW, MEASURE_UNIT, MEDICATIONS, ROLL_END,
    ROLL_START, STUDY_END, STUDY_START, TARGET, TREATMENTS, Views,
)

MEASURED, MODERATE, SEVERE, MEASUREMENT = (1, 2), (3,), (4,), (5, 6, 7)


def rules(v: Views, mode: str = "earliest_positive") -> outcome.OutcomeRules:
    return outcome.OutcomeRules(
        v.brand_list("ck", *MEASURED), v.brand_list("myopathy", *MODERATE), v.brand_list("rhabdo", *SEVERE),
        bands=BANDS, accepted=ACCEPTED, convert=CONVERT, target=TARGET, mode=mode,
    )


def study(v: Views, with_outcome: bool = True, with_exclusion: bool = True) -> cohort.Study:
    return cohort.Study(
        v.exposure_codes, STUDY_START, STUDY_END, exclusion=v.exclusion_codes if with_exclusion else None,
        exclusion_in="drugs", outcome=rules(v) if with_outcome else None,
    )


def covariates(v: Views) -> cohort.Covariates:
    return cohort.Covariates(
        v.medication_lists, MEDICATIONS, v.condition_lists, CONDITIONS, v.brand_list("bmi", *MEASUREMENT), v.units,
        v.ethnicity, TREATMENTS, MEASURE_UNIT, (MEASURE_LOW, MEASURE_HIGH),
    )


def of_study(v: Views, s: cohort.Study, c: cohort.Covariates | None = None) -> Views:
    """The views with observations of the codes that the study and its covariates ask for there."""
    lists = [s.outcome.lists, *([s.exclusion] if s.exclusion_in == "events" else []), *([c.conditions, c.measurement] if c else [])]
    return v.of_codes(long_codelist(x.select("code") for x in lists))


def with_outcome(v: Views, patients: DataFrame, mode: str = "earliest_positive") -> DataFrame:
    r = rules(v, mode)
    return outcome.add_outcome(patients, v.of_codes(r.lists).observation, r)


# SQL parts, each stated with rankings and subqueries rather than the aggregates used above.
EXPOSED_PATIENTS = """SELECT p.*, f.issuedate AS first_exposure_date, f.drugsubstancename,
    CAST(f.issuedate - p.regstartdate AS INTEGER) AS time_to_first_exposure FROM patient p LEFT JOIN firsts f ON p.patid = f.patid"""
LOOKBACK = "SELECT *, first_exposure_date - 365 AS study_entry_date FROM exposed_patients WHERE time_to_first_exposure >= 365"
IN_PERIOD = f"first_exposure_date BETWEEN DATE '{STUDY_START}' AND DATE '{STUDY_END}'"
ADULT = "first_exposure_date >= make_date(yob + 18, 7, 31)"
NOT_EXCLUDED = """NOT EXISTS (SELECT 1 FROM drug_issue d JOIN exclusion_codes c ON d.prodcodeid = c.code
    WHERE d.patid = e.patid AND coalesce(d.issuedate, d.enterdate) > e.study_entry_date)"""
SINGLE = "SELECT patid FROM exposed GROUP BY patid HAVING count(DISTINCT drugsubstancename) = 1"


def _brands(*numbers: int) -> str:
    return "(" + ", ".join(f"'Brand#{n}'" for n in numbers) + ")"


_NUMBER = "CASE WHEN numunitid = '155' THEN value * 1.5 ELSE value END"
_BANDS = " ".join(
    f"WHEN gender = '{g}' THEN CASE WHEN num <= {lo} THEN 0 WHEN num <= {hi} THEN 1 WHEN num > {hi} THEN 2 END" for g, (lo, hi) in BANDS.items()
)
def coded_sql(measured: str, moderate: str, severe: str) -> str:
    """Outcome events; each argument is a list of codes in brackets."""
    return f"""SELECT patid, medcodeid, outcome_date, num, numunitid, code, CASE code WHEN 2 THEN 0 WHEN 1 THEN 1 WHEN 3 THEN 2 WHEN 0 THEN 3 ELSE 4 END AS rk FROM (
    SELECT patid, medcodeid, numunitid, num, coalesce(obsdate, enterdate) AS outcome_date,
        CASE WHEN medcodeid IN {severe} THEN 2 WHEN medcodeid IN {moderate} THEN 1
        WHEN numunitid NOT IN ('276', '155') THEN 3 ELSE CASE {_BANDS} END END AS code
    FROM (SELECT o.*, {_NUMBER} AS num, p.gender FROM observation o LEFT JOIN patient p USING (patid)
          WHERE medcodeid IN {measured} OR medcodeid IN {moderate} OR medcodeid IN {severe}))"""


CODED = coded_sql(_brands(*MEASURED), _brands(*MODERATE), _brands(*SEVERE))
EARLIEST = """SELECT patid, code, outcome_date FROM (SELECT *, row_number() OVER (PARTITION BY patid ORDER BY outcome_date NULLS LAST, rk) AS rn
    FROM coded WHERE code > 0) WHERE rn = 1"""
VERY_FIRST = """SELECT patid, code, outcome_date FROM (SELECT *, row_number() OVER (PARTITION BY patid ORDER BY outcome_date NULLS FIRST, rk) AS rn
    FROM coded) WHERE rn = 1 AND code > 0"""
def cohort_sql(not_excluded: str, single: str) -> str:
    return f"""SELECT e.patid, gender, yob, mob, emis_ddate, regenddate, first_exposure_date, drugsubstancename, study_entry_date,
    coalesce(x.code, 0) AS outcome, x.outcome_date FROM lookback e LEFT JOIN earliest x ON e.patid = x.patid
    WHERE acceptable = '1' AND {IN_PERIOD} AND {ADULT} AND {not_excluded} AND coalesce(x.code, 0) <> 3
    AND (x.outcome_date IS NULL OR x.outcome_date >= first_exposure_date) AND {single}"""


COHORT = cohort_sql(NOT_EXCLUDED, "e.patid IN (SELECT patid FROM single)")
BASE = {"exposed": EXPOSED, "firsts": FIRST, "exposed_patients": EXPOSED_PATIENTS, "lookback": LOOKBACK}
OUTCOMES = {"coded": CODED, "earliest": EARLIEST, "very_first": VERY_FIRST}
FULL = {**BASE, **OUTCOMES, "single": SINGLE, "cohort": COHORT}

COHORT_COLUMNS = [
    "patid", "gender", "yob", "mob", "emis_ddate", "regenddate", "first_exposure_date", "drugsubstancename", "study_entry_date",
    "outcome", "outcome_date",
]


def exposed(v: Views) -> DataFrame:
    return exposure.add_first_exposure(v.patient, v.drug_issue, v.exposure_codes)


def accepted(v: Views) -> DataFrame:
    s = study(v)
    return cohort.acceptable_cohort(v.patient, v.drug_issue, of_study(v, s).observation, s)


@query("add_first_exposure", "SELECT patid, first_exposure_date, drugsubstancename, time_to_first_exposure FROM exposed_patients", **BASE)
def _(v: Views):
    return exposed(v).select("patid", "first_exposure_date", "drugsubstancename", "time_to_first_exposure")


@query("require_lookback", "SELECT patid, first_exposure_date, study_entry_date FROM lookback", **BASE)
def _(v: Views):
    return exposure.require_lookback(exposed(v)).select("patid", "first_exposure_date", "study_entry_date")


@query("require_period", f"SELECT patid, first_exposure_date FROM exposed_patients WHERE {IN_PERIOD}", **BASE)
def _(v: Views):
    return exposure.require_period(exposed(v), STUDY_START, STUDY_END).select("patid", "first_exposure_date")


@query("require_adult", f"SELECT patid, yob, first_exposure_date FROM exposed_patients WHERE {ADULT}", **BASE)
def _(v: Views):
    return exposure.require_adult(exposed(v)).select("patid", "yob", "first_exposure_date")


@query("events_before_index", "SELECT d.patid, prodcodeid, issuedate FROM drug_issue d JOIN exposed_patients e ON d.patid = e.patid WHERE issuedate BETWEEN first_exposure_date - 90 AND first_exposure_date", **BASE)
def _(v: Views):
    return events.events_before_index(v.drug_issue.select("patid", "prodcodeid", "issuedate"), exposed(v), 90, "issuedate", "first_exposure_date")


@query("exclude_events_after", f"SELECT patid, study_entry_date FROM lookback e WHERE {NOT_EXCLUDED}", **BASE)
def _(v: Views):
    kept = cohort.exclude_events_after(
        exposure.require_lookback(exposed(v)), v.drug_issue, v.exclusion_codes, code="prodcodeid", dates=("issuedate", "enterdate")
    )
    return kept.select("patid", "study_entry_date")


@query("single_class_patients", "SELECT patid, min(drugsubstancename) AS drugsubstancename FROM exposed WHERE patid IN (SELECT patid FROM single) AND issuedate IS NOT NULL GROUP BY patid UNION ALL SELECT patid, NULL FROM single WHERE patid NOT IN (SELECT patid FROM exposed WHERE issuedate IS NOT NULL)", exposed=EXPOSED, single=SINGLE)
def _(v: Views):
    return exposure.single_class_patients(v.drug_issue, v.exposure_codes)


@query("require_single_class", "SELECT patid, gender FROM patient WHERE patid IN (SELECT patid FROM single)", exposed=EXPOSED, single=SINGLE)
def _(v: Views):
    return exposure.require_single_class(v.patient, v.drug_issue, v.exposure_codes).select("patid", "gender")


OUTCOME_SQL = "SELECT p.patid, gender, CAST(coalesce(x.code, 0) AS INTEGER) AS outcome, x.outcome_date FROM patient p LEFT JOIN {} x ON p.patid = x.patid"


@query("outcome_events", "SELECT patid, medcodeid, outcome_date, num AS value, CASE WHEN numunitid = '155' THEN 276 ELSE CAST(numunitid AS INTEGER) END AS numunitid, CAST(code AS INTEGER) AS outcome_code FROM coded", **OUTCOMES)
def _(v: Views):
    return outcome.outcome_events(v.patient, v.observation, rules(v)).select(
        "patid", "medcodeid", "outcome_date", "value", "numunitid", "outcome_code"
    )


@query("union_outcomes", "SELECT patid, outcome_date, CAST(code AS INTEGER) AS outcome_code FROM coded", **OUTCOMES)
def _(v: Views):
    """The three kinds of outcome event in one frame: tagged in one pass, not found list by list."""
    rows = outcome.outcome_events(v.patient, v.observation, rules(v))
    kinds = [outcome.MEASURED, outcome.MODERATE, outcome.SEVERE]
    return rows.filter(F.col("list_name").isin(kinds)).select("patid", "outcome_date", "outcome_code")


@query("add_outcome", OUTCOME_SQL.format("earliest"), **OUTCOMES)
def _(v: Views):
    return with_outcome(v, v.patient).select("patid", "gender", "outcome", "outcome_date")


@query("add_outcome_first_record", OUTCOME_SQL.format("very_first"), **OUTCOMES)
def _(v: Views):
    return with_outcome(v, v.patient, "first_record").select("patid", "gender", "outcome", "outcome_date")


@query("exclude_prior_outcome", """SELECT e.patid, first_exposure_date, CAST(coalesce(x.code, 0) AS INTEGER) AS outcome, x.outcome_date FROM exposed_patients e
    LEFT JOIN earliest x ON e.patid = x.patid WHERE coalesce(x.code, 0) <> 3 AND NOT coalesce(x.outcome_date < first_exposure_date, FALSE)""", **BASE, **OUTCOMES)
def _(v: Views):
    rows = with_outcome(v, exposed(v))
    return outcome.exclude_prior_outcome(rows).select("patid", "first_exposure_date", "outcome", "outcome_date")


@query("acceptable_cohort", "SELECT * REPLACE (CAST(outcome AS INTEGER) AS outcome) FROM cohort", **FULL)
def _(v: Views):
    return accepted(v).select(*COHORT_COLUMNS)


@query("restrict_events", "SELECT patid, prodcodeid, issuedate FROM drug_issue WHERE patid IN (SELECT patid FROM cohort)", **FULL)
def _(v: Views):
    return cohort.restrict_events(accepted(v), v.drug_issue.select("patid", "prodcodeid", "issuedate"))[0]


_STEPS = [
    ("all", "TRUE"), ("acceptable", "acceptable = '1'"), ("lookback", "coalesce(time_to_first_exposure >= 365, FALSE)"),
    ("period", f"coalesce({IN_PERIOD}, FALSE)"), ("adult", f"coalesce({ADULT}, FALSE)"), ("exclusion", "not_excluded"),
    ("no_prior_outcome", "code <> 3 AND NOT coalesce(outcome_date < first_exposure_date, FALSE)"), ("single_class", "single"),
]


def _attrition_sql(names: list[str]) -> str:
    wanted = [(n, c) for n, c in _STEPS if n in names]
    passed = "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT {i} AS step_no, '{n}' AS step, count(*) FILTER (WHERE " + " AND ".join(f"({c})" for _, c in wanted[: i + 1]) + ") AS remaining FROM steps"
        for i, (n, _) in enumerate(wanted)
    ) + ")"
    return f"SELECT step_no, step, remaining, coalesce(lag(remaining) OVER (ORDER BY step_no) - remaining, 0) AS excluded FROM ({passed})"


def step_rows_sql(not_excluded: str) -> str:
    return f"""SELECT e.*, coalesce(x.code, 0) AS code, x.outcome_date, e.patid IN (SELECT patid FROM single) AS single, {not_excluded} AS not_excluded
    FROM (SELECT *, first_exposure_date - 365 AS study_entry_date FROM exposed_patients) e LEFT JOIN earliest x ON e.patid = x.patid"""


STEP_ROWS = step_rows_sql(NOT_EXCLUDED)


@query("attrition_table", _attrition_sql([n for n, _ in _STEPS]), **FULL, steps=STEP_ROWS)
def _(v: Views):
    s = study(v)
    return cohort.cohort_attrition(v.patient, v.drug_issue, of_study(v, s).observation, s)


@query("attrition_table_drugs", _attrition_sql([n for n, _ in _STEPS if n != "no_prior_outcome"]), **FULL, steps=STEP_ROWS)
def _(v: Views):
    return cohort.cohort_attrition(v.patient, v.drug_issue, None, study(v, with_outcome=False))


LAST = """SELECT patid, issuedate, duration FROM (SELECT *, row_number() OVER (PARTITION BY patid ORDER BY issuedate DESC, duration DESC NULLS LAST) AS rn
    FROM exposed WHERE issuedate IS NOT NULL) WHERE rn = 1"""
STUDY_ENDS = f"""SELECT c.*, l.issuedate + coalesce(l.duration + 120, 180) AS censor_date,
    least(emis_ddate, regenddate, DATE '{STUDY_END}', outcome_date, l.issuedate + coalesce(l.duration + 120, 180)) AS study_exit_date
    FROM cohort c LEFT JOIN lasts l ON c.patid = l.patid"""
CENSORED = """SELECT * REPLACE (CASE WHEN outcome_date > study_exit_date THEN 0 ELSE outcome END AS outcome,
    CASE WHEN outcome_date > study_exit_date THEN NULL ELSE outcome_date END AS outcome_date) FROM study_ends"""
ENDED = {**FULL, "lasts": LAST, "study_ends": STUDY_ENDS, "censored": CENSORED}


def _with_end(v: Views) -> DataFrame:
    return exposure.add_study_end(accepted(v), STUDY_END)


@query("add_study_end", "SELECT patid, censor_date, study_exit_date FROM study_ends", **ENDED)
def _(v: Views):
    return _with_end(v).select("patid", "censor_date", "study_exit_date")


@query("add_study_end_all", f"""SELECT p.patid, l.issuedate + coalesce(l.duration + 120, 180) AS censor_date, least(emis_ddate, regenddate, DATE '{STUDY_END}',
    x.outcome_date, l.issuedate + coalesce(l.duration + 120, 180)) AS study_exit_date FROM patient p LEFT JOIN lasts l ON p.patid = l.patid
    LEFT JOIN earliest x ON p.patid = x.patid""", **ENDED)
def _(v: Views):
    rows = with_outcome(v, v.patient)
    return exposure.add_study_end(rows, STUDY_END, v.drug_issue, v.exposure_codes).select("patid", "censor_date", "study_exit_date")


@query("censor_outcome", f"""SELECT p.patid, CASE WHEN x.outcome_date > DATE '1998-06-30' THEN 0 ELSE CAST(coalesce(x.code, 0) AS INTEGER) END AS outcome,
    CASE WHEN x.outcome_date > DATE '1998-06-30' THEN NULL ELSE x.outcome_date END AS outcome_date FROM patient p LEFT JOIN earliest x ON p.patid = x.patid""", **OUTCOMES)
def _(v: Views):
    rows = with_outcome(v, v.patient).withColumn("study_exit_date", F.lit("1998-06-30").cast("date"))
    return exposure.censor_outcome(rows).select("patid", "outcome", "outcome_date")


MEDICATION_SQL = ", ".join(
    f"""CAST(EXISTS (SELECT 1 FROM medicated m WHERE m.patid = b.patid AND m.list_name = '{n}'
    AND m.used_on BETWEEN b.study_entry_date AND b.first_exposure_date) AS INTEGER) AS {n}"""
    for n in MEDICATIONS
)
MEDICATED = "SELECT patid, list_name, coalesce(issuedate, enterdate) AS used_on FROM drug_issue JOIN medication_lists ON prodcodeid = code"


@query("baseline_exposure_flags", f"SELECT patid, {MEDICATION_SQL} FROM lookback b", **BASE, medicated=MEDICATED)
def _(v: Views):
    patients = exposure.require_lookback(exposed(v)).select("patid", "study_entry_date", F.col("first_exposure_date").alias("index_date"))
    return flags.baseline_exposure_flags(patients, v.drug_issue, v.medication_lists, MEDICATIONS).select("patid", *MEDICATIONS)


@query("baseline_exposure_flag", """SELECT patid, CAST(EXISTS (SELECT 1 FROM drug_issue d JOIN exclusion_codes c ON d.prodcodeid = c.code WHERE d.patid = b.patid
    AND coalesce(issuedate, enterdate) BETWEEN study_entry_date AND first_exposure_date) AS INTEGER) AS used FROM lookback b""", **BASE)
def _(v: Views):
    patients = exposure.require_lookback(exposed(v)).select("patid", "study_entry_date", F.col("first_exposure_date").alias("index_date"))
    return flags.baseline_exposure_flag(patients, v.drug_issue, v.exclusion_codes, "used").select("patid", "used")


DISEASED = "SELECT patid, list_name, coalesce(obsdate, enterdate) AS seen_on FROM observation JOIN condition_lists ON medcodeid = code"
CONDITION_SQL = ", ".join(
    f"CAST(EXISTS (SELECT 1 FROM diseased m WHERE m.patid = b.patid AND m.list_name = '{n}' AND coalesce(m.seen_on <= b.first_exposure_date, m.seen_on IS NOT NULL)) AS INTEGER) AS {n}"
    for n in CONDITIONS
)


@query("condition_flags", f"SELECT patid, {CONDITION_SQL} FROM exposed_patients b", **BASE, diseased=DISEASED)
def _(v: Views):
    patients = exposed(v).select("patid", F.col("first_exposure_date").alias("index_date"))
    return flags.condition_flags(patients, v.observation, v.condition_lists, CONDITIONS).select("patid", *CONDITIONS)


@query("earliest_condition", "SELECT patid, " + ", ".join(f"min(CASE WHEN list_name = '{c}' THEN seen_on END) AS {c}" for c in CONDITIONS) + " FROM diseased GROUP BY patid", diseased=DISEASED)
def _(v: Views):
    rows = flags.earliest_condition(v.observation, v.condition_lists, CONDITIONS)
    return rows.select("patid", *[F.col(f"obsdate_{c}").alias(c) for c in CONDITIONS])


FIRST_SEEN = """SELECT patid, list_name, seen_on FROM (SELECT o.patid, c.list_name, coalesce(obsdate, enterdate) AS seen_on,
    rank() OVER (PARTITION BY o.patid ORDER BY coalesce(obsdate, enterdate) NULLS FIRST) AS rk
    FROM observation o LEFT JOIN condition_lists c ON medcodeid = code) WHERE rk = 1"""


@query("earliest_condition_first_record", "SELECT patid, " + ", ".join(f"CAST(max(CASE WHEN list_name = '{c}' THEN 1 END) AS INTEGER) AS {c}" for c in CONDITIONS) + " FROM first_seen GROUP BY patid", first_seen=FIRST_SEEN)
def _(v: Views):
    return flags.earliest_condition(v.observation, v.condition_lists, CONDITIONS, "first_record").select("patid", *CONDITIONS)


@query("validate_condition_dates", "SELECT patid, CAST(max(CASE WHEN seen_on IS NOT NULL AND seen_on <= DATE '1997-06-30' THEN 1 ELSE 0 END) AS INTEGER) AS asthma FROM diseased WHERE list_name = 'asthma' GROUP BY patid", diseased=DISEASED)
def _(v: Views):
    rows = flags.earliest_condition(v.observation, v.condition_lists.filter("list_name = 'asthma'"), ["asthma"])
    rows = rows.withColumn("index_date", F.lit("1997-06-30").cast("date"))
    return flags.validate_condition_dates(rows, ["asthma"], "index_date").select("patid", "asthma")


MEASURED_ON = f"""SELECT patid, coalesce(obsdate, enterdate) AS measured_on, value FROM observation o JOIN units u ON CAST(o.numunitid AS INTEGER) = u.numunitid
    WHERE medcodeid IN {_brands(*MEASUREMENT)} AND Description = '{MEASURE_UNIT}' AND value BETWEEN {MEASURE_LOW} AND {MEASURE_HIGH}"""
LATEST = "SELECT patid, measured_on, value FROM (SELECT *, row_number() OVER (PARTITION BY patid ORDER BY measured_on DESC, value DESC) AS rn FROM measured) WHERE rn = 1"


def _measure(v: Views, **options) -> DataFrame:
    return flags.latest_measurement(
        v.observation, v.brand_list("bmi", *MEASUREMENT), v.units, low=MEASURE_LOW, high=MEASURE_HIGH, unit=MEASURE_UNIT, **options
    )


@query("latest_measurement", 'SELECT patid, measured_on AS "obsdate_BMI", value AS "BMI" FROM latest', measured=MEASURED_ON, latest=LATEST)
def _(v: Views):
    return _measure(v)


@query("latest_measurement_as_of", """SELECT patid, measured_on AS "obsdate_BMI", value AS "BMI" FROM (SELECT m.*, row_number() OVER (PARTITION BY patid ORDER BY measured_on DESC, value DESC) AS rn
    FROM measured m JOIN firsts f USING (patid) WHERE measured_on <= f.issuedate) WHERE rn = 1""", **BASE, measured=MEASURED_ON)
def _(v: Views):
    patients = exposed(v).filter("first_exposure_date IS NOT NULL")
    return _measure(v, patients=patients, as_of="first_exposure_date")


_TREATMENT = "CASE drugsubstancename " + " ".join(f"WHEN '{t}' THEN {n}" for t, n in TREATMENTS.items()) + " END"
_BIRTHDAY = "CASE WHEN mob IS NULL THEN make_date(yob, 7, 31) ELSE last_day(make_date(yob, mob, 1)) END"


RESEARCH = f"""SELECT b.patid, gender, CAST(outcome AS INTEGER) AS outcome, {MEDICATION_SQL}, {CONDITION_SQL},
    CAST(floor((first_exposure_date - {_BIRTHDAY}) / 365.25) AS INTEGER) AS age_at_exposure, m.value AS "BMI",
    ethnic_6 AS "Ethnic", CAST({_TREATMENT} AS INTEGER) AS treatment
    FROM censored b JOIN ethnicity ON b.patid = ethnicity.patid LEFT JOIN latest m ON b.patid = m.patid WHERE gender <> '3'"""
COVARIATES = {"medicated": MEDICATED, "diseased": DISEASED, "measured": MEASURED_ON, "latest": LATEST}


@query("research_dataset", RESEARCH, **ENDED, **COVARIATES)
def research(v: Views):
    s, c = study(v), covariates(v)
    return cohort.research_dataset(v.patient, v.drug_issue, of_study(v, s, c).observation, s, c)


@query("first_treatment_share", "SELECT drugsubstancename AS treatment, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM firsts GROUP BY 1", exposed=EXPOSED, firsts=FIRST)
def _(v: Views):
    profile = exposure.exposure_profile(v.drug_issue, v.exposure_codes)
    return patterns.first_treatment_share(profile).withColumn("percent", F.round("percent", 6))


@query("classes_per_patient_hist", "SELECT classes, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM (SELECT patid, count(DISTINCT drugsubstancename) AS classes FROM exposed GROUP BY 1) GROUP BY 1", exposed=EXPOSED)
def _(v: Views):
    rows = patterns.exposures(v.drug_issue, v.exposure_codes)
    return patterns.classes_per_patient_hist(rows).withColumn("percent", F.round("percent", 6))


SEQUENCE = """SELECT patid, issuedate, drugsubstancename, lower(substr(drugsubstancename, 1, 1)) AS letter, i FROM (
    SELECT *, row_number() OVER w AS i, lag(drugsubstancename) OVER w AS prev, count(*) OVER (PARTITION BY patid) AS n FROM exposed WHERE issuedate IS NOT NULL
    WINDOW w AS (PARTITION BY patid ORDER BY issuedate, drugsubstancename)) WHERE i = 1 OR i = n OR drugsubstancename <> prev"""


def _sequences(v: Views) -> DataFrame:
    return patterns.treatment_sequence(patterns.exposures(v.drug_issue, v.exposure_codes))


@query("treatment_sequence", "SELECT patid, string_agg(letter, ',' ORDER BY i) AS letters, CAST(count(*) AS INTEGER) AS length, min(issuedate) AS first_on, max(issuedate) AS last_on FROM sequences GROUP BY patid", exposed=EXPOSED, sequences=SEQUENCE)
def _(v: Views):
    ends = {"first_on": F.get("prescribing_pattern", F.lit(0))["issuedate"], "last_on": F.element_at("prescribing_pattern", -1)["issuedate"]}
    rows = _sequences(v).withColumns(ends).drop("prescribing_pattern")
    return flatten_arrays_for_csv(rows)


LETTERS = "SELECT letters, count(*) AS count, CAST(length AS INTEGER) AS list_length FROM (SELECT patid, string_agg(letter, ',' ORDER BY i) AS letters, count(*) AS length FROM sequences GROUP BY patid) GROUP BY 1, 3"


@query("sequence_counts", LETTERS, exposed=EXPOSED, sequences=SEQUENCE)
def _(v: Views):
    return flatten_arrays_for_csv(patterns.sequence_counts(_sequences(v)))


@query("top_patterns", f"SELECT * FROM ({LETTERS}) ORDER BY count DESC, string_split(letters, ',') LIMIT 20", exposed=EXPOSED, sequences=SEQUENCE)
def _(v: Views):
    return flatten_arrays_for_csv(patterns.top_patterns(patterns.sequence_counts(_sequences(v))))


ROLL_LISTS = (("active", ("purchase", "signup")), ("problem", ("error",)), ("seen", ("view", "click", "error")))


# The cross-section looks at drugs in an earlier period, moved back by so many days.
DRUG_LISTS, DRUG_SHIFT = (("drug_a", ("click",)), ("drug_b", ("purchase", "error"))), 4


def _roll_lists(v: Views, lists=ROLL_LISTS) -> DataFrame:
    codes = v.table("events").select(F.col("event_type").alias("code")).distinct()
    return union_lists([
        codes.filter(F.col("code").isin(list(types))).select(F.lit(name).alias("list_name"), "code", F.col("code").alias("term"))
        for name, types in lists
    ])


_PERIOD = f"EffectiveDate BETWEEN DATE '{ROLL_START}' AND DATE '{ROLL_END}'"


def _roll_code_columns(lists=ROLL_LISTS) -> str:
    out = []
    for name, types in lists:
        mine = "CodeId IN (" + ", ".join(f"'{t}'" for t in types) + ")"
        out.append(
            f"""string_agg(DISTINCT CASE WHEN {mine} THEN CAST(EffectiveDate AS VARCHAR) END, ',' ORDER BY CASE WHEN {mine} THEN CAST(EffectiveDate AS VARCHAR) END) AS "timestamps@[{name}]",
            max(CASE WHEN {mine} THEN EffectiveDate END) AS "latest@[{name}]", min(CASE WHEN {mine} THEN EffectiveDate END) AS "earliest@[{name}]",
            CAST(max(CASE WHEN {mine} THEN 1 END) AS INTEGER) AS "[{name}]" """
        )
    return ", ".join(out)


ROLL_CODES = f"SELECT PatientIdentifier, {_roll_code_columns()} FROM roll_event WHERE {_PERIOD} GROUP BY 1"


def _null_empty(df: DataFrame) -> DataFrame:
    return df.withColumns({f"`{c}`".strip("`"): F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")) for c in df.columns if c.startswith("timestamps@")})


def _rolled_codes(v: Views) -> DataFrame:
    return rollup.rollup_codes(v.roll_event, _roll_lists(v), [n for n, _ in ROLL_LISTS], ROLL_START, ROLL_END)


@query("rollup_codes", ROLL_CODES)
def _(v: Views):
    return _null_empty(flatten_arrays_for_csv(_rolled_codes(v)))


_VALUE_COLUMNS = ", ".join(
    f"""round(avg(CASE WHEN CodeId = '{t}' THEN coalesce(Value, 1) END), 6) AS "mean@{t}", max(CASE WHEN CodeId = '{t}' THEN coalesce(Value, 1) END) AS "max@{t}",
    min(CASE WHEN CodeId = '{t}' THEN coalesce(Value, 1) END) AS "min@{t}" """
    for t in EVENT_TYPES
)
ROLL_VALUES = f"SELECT PatientIdentifier, {_VALUE_COLUMNS} FROM roll_event WHERE {_PERIOD} GROUP BY 1"


def _rolled_values(v: Views) -> DataFrame:
    rows = rollup.rollup_values(v.roll_event, EVENT_TYPES, ROLL_START, ROLL_END)
    return rows.withColumns({f"mean@{t}": F.round(f"mean@{t}", 6) for t in EVENT_TYPES})


@query("rollup_values", ROLL_VALUES)
def _(v: Views):
    return _rolled_values(v)


@query("full_outer_by_union", f"SELECT coalesce(c.PatientIdentifier, w.PatientIdentifier) AS PatientIdentifier, c.* EXCLUDE (PatientIdentifier), w.* EXCLUDE (PatientIdentifier) FROM (SELECT * FROM ({ROLL_CODES}) WHERE PatientIdentifier % 3 <> 0) c FULL OUTER JOIN ({ROLL_VALUES}) w ON c.PatientIdentifier = w.PatientIdentifier")
def _(v: Views):
    wide = joins.outer(_rolled_codes(v).filter("PatientIdentifier % 3 <> 0"), _rolled_values(v), "PatientIdentifier")
    return _null_empty(flatten_arrays_for_csv(wide))


@query("value_timeline", f"""SELECT PatientIdentifier, CodeId, EffectiveDate, coalesce(e.Value, 1.0) AS "Value", count(*) AS copies
    FROM roll_event e WHERE {_PERIOD} GROUP BY 1, 2, 3, 4""")
def _(v: Views):
    return rollup.value_timeline(v.roll_event, EVENT_TYPES, ROLL_START, ROLL_END)


def _terms(v: Views) -> DataFrame:
    codes = v.table("events").select(F.col("event_type").alias("code")).distinct()
    return codes.filter("code IN ('error', 'signup')").select("code", F.upper("code").alias("term"))


ROLL_CATEGORY = """SELECT PatientIdentifier, max(EffectiveDate) AS "latest@category", arg_max(upper(CodeId), CAST(EffectiveDate AS VARCHAR) || upper(CodeId)) AS "term@category"
    FROM roll_event WHERE CodeId IN ('error', 'signup') GROUP BY 1"""


@query("rollup_category", ROLL_CATEGORY)
def _(v: Views):
    return rollup.rollup_category(v.roll_event, _terms(v))


@query("category_entries", """SELECT DISTINCT PatientIdentifier, upper(CodeId) || '@' || coalesce(CAST(Value AS VARCHAR), '') AS entry
    FROM roll_event WHERE CodeId IN ('error', 'signup')""")
def _(v: Views):
    return rollup.category_entries(v.roll_event, _terms(v))


_MOVED = f"EffectiveDate BETWEEN DATE '{ROLL_START}' - {DRUG_SHIFT} AND DATE '{ROLL_END}' - {DRUG_SHIFT}"
_DRUG_TYPES = ", ".join(f"'{t}'" for _, types in DRUG_LISTS for t in types)
ROLL_DRUGS = f"SELECT PatientIdentifier, {_roll_code_columns(DRUG_LISTS)} FROM roll_event WHERE {_MOVED} AND CodeId IN ({_DRUG_TYPES}) GROUP BY 1"


@query("cross_section", f"""SELECT p.PatientIdentifier, c.* EXCLUDE (PatientIdentifier), d.* EXCLUDE (PatientIdentifier), w.* EXCLUDE (PatientIdentifier),
    k.* EXCLUDE (PatientIdentifier), Sex, YearOfBirth, DateOfDeath FROM roll_patient p LEFT JOIN ({ROLL_CODES}) c ON c.PatientIdentifier = p.PatientIdentifier
    LEFT JOIN ({ROLL_DRUGS}) d ON d.PatientIdentifier = p.PatientIdentifier LEFT JOIN ({ROLL_VALUES}) w ON w.PatientIdentifier = p.PatientIdentifier
    LEFT JOIN ({ROLL_CATEGORY}) k ON k.PatientIdentifier = p.PatientIdentifier
    WHERE IsAcceptable = '1' AND p.PatientIdentifier IN (SELECT PatientIdentifier FROM roll_event)
    AND coalesce(c.PatientIdentifier, d.PatientIdentifier, w.PatientIdentifier, k.PatientIdentifier) IS NOT NULL""")
def _(v: Views):
    names = [n for n, _ in DRUG_LISTS]
    drugs = rollup.rollup_codes(v.roll_event, _roll_lists(v, DRUG_LISTS), names, ROLL_START, ROLL_END, DRUG_SHIFT)
    category = rollup.rollup_category(v.roll_event, _terms(v))
    wide = rollup.cross_section(v.roll_patient, [_rolled_codes(v), drugs, _rolled_values(v), category])
    return _null_empty(flatten_arrays_for_csv(wide))


@query("relevant_records", f"""SELECT DISTINCT PatientIdentifier, CodeId, EffectiveDate, Value FROM roll_event e WHERE ({_PERIOD} AND (PatientIdentifier, CodeId) IN
    (SELECT PatientIdentifier, CodeId FROM roll_event WHERE CodeId = 'error' AND EffectiveDate = DATE '{ROLL_START}')) OR CodeId = 'signup'""")
def _(v: Views):
    pairs = v.roll_event.filter(f"CodeId = 'error' AND EffectiveDate = DATE '{ROLL_START}'")
    extra = rollup.value_events(v.roll_event.withColumn("keep", F.col("Value")), ["signup"]).withColumn("Value", F.col("keep")).drop("keep")
    return rollup.relevant_records(v.roll_event, pairs, ROLL_START, ROLL_END, extra)
