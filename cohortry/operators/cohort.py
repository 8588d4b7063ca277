"""From raw tables to the eligible cohort, its attrition table and the research dataset."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import TREATMENT_CODES, case_recode, value_exclude
from ..functions.dates import age_at, birthday_bound
from ..sources.tables import materialise
from .exposure import (
    add_study_end, censor_outcome, exposure_part, unpack_exposure, with_study_entry, with_time_to_exposure,
)
from .flags import (
    BMI_HIGH, BMI_LOW, BMI_UNIT, condition_part, conditions_found, measurement_part, medication_part, unpack_conditions,
    unpack_measurement, unpack_medications, with_unit,
)
from .joins import attach_ethnicity, patient_semi
from .keyfilter import early_filter
from .outcome import OutcomeRules, no_prior_outcome, outcome_part, unpack_outcome
from .summaries import ON, Part, in_role, role, summarise_events

EXCLUSION = "exclusion"


def exclusion_part(codes: DataFrame) -> Part:
    """The last day on which a patient has an event of the list."""
    return Part(role(codes, EXCLUSION), [F.max(F.when(in_role(EXCLUSION), F.col(ON))).alias("_last_excluded")])


def exclude_events_after(
    patients: DataFrame, events: DataFrame, codes: DataFrame, after: str = "study_entry_date", code: str = "medcodeid",
    dates: tuple[str, str] = ("obsdate", "enterdate"),
) -> DataFrame:
    """Drop patients with a listed event strictly after the date in ``after``."""
    last = summarise_events(events, [exclusion_part(codes)], code, dates)
    late = F.coalesce(F.col("_last_excluded") > F.col(after), F.lit(False))
    return patients.join(last, "patid", "left").filter(~late).drop("_last_excluded")


@dataclass
class Study:
    """Codelists and limits of one study. ``exclusion_in`` ("events" or "drugs") is the table that holds exclusion
    codes; ``single_class`` keeps only patients that ever had one class of the exposure."""

    exposure: DataFrame
    start: str
    end: str
    lookback: int = 365
    adult: int = 18
    exclusion: DataFrame | None = None
    exclusion_in: str = "events"
    single_class: bool = True
    outcome: OutcomeRules | None = None
    drug_dates: tuple[str, str] = ("issuedate", "enterdate")
    event_dates: tuple[str, str] = ("obsdate", "enterdate")


def steps(study: Study) -> list[tuple[str, Column]]:
    """The conditions of the study in order, on the columns that ``eligibility`` adds."""
    first = F.col("first_exposure_date")
    out = [
        ("acceptable", F.col("acceptable").cast("string") == "1"),
        ("lookback", F.col("time_to_first_exposure") >= study.lookback),
        ("period", first.between(F.lit(study.start).cast("date"), F.lit(study.end).cast("date"))),
        ("adult", first >= birthday_bound("yob", study.adult)),
    ]
    if study.exclusion is not None:
        out.append(("exclusion", ~F.coalesce(F.col("_last_excluded") > F.col("study_entry_date"), F.lit(False))))
    if study.outcome is not None:
        out.append(("no_prior_outcome", no_prior_outcome()))
    if study.single_class:
        out.append(("single_class", F.col("single_class")))
    return out


def eligibility(
    patients: DataFrame, drugs: DataFrame, events: DataFrame | None, study: Study,
    drug_parts: Sequence[Part] = (), event_parts: Sequence[Part] = (), early: bool = False,
) -> DataFrame:
    """All patients with exposure, exclusion and outcome columns. Each event table is scanned once.

    Further parts ride along in the same scans. With ``early`` only patients are returned that pass the steps
    told by patients and drugs alone: they are worked out and stored first, and events of others are
    dropped by a filter of their keys before anything is tagged, sorted or shuffled.
    """
    on_drugs, on_events = [exposure_part(study.exposure, study.drug_dates[0]), *drug_parts], list(event_parts)
    if study.exclusion is not None:
        (on_drugs if study.exclusion_in == "drugs" else on_events).append(exclusion_part(study.exclusion))
    if study.outcome is not None:
        on_events.append(outcome_part(study.outcome))
    summary = summarise_events(drugs, on_drugs, "prodcodeid", study.drug_dates)
    out = with_study_entry(with_time_to_exposure(unpack_exposure(patients.join(summary, "patid", "left"))), study.lookback)
    if on_events and early:
        out = materialise(keep_eligible(out, study, events_known=False))
        events = early_filter(events, out)
    if on_events:
        out = out.join(summarise_events(events, on_events, "medcodeid", study.event_dates), "patid", "left")
    return unpack_outcome(out, study.outcome) if study.outcome is not None else out


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def keep_eligible(patients: DataFrame, study: Study, events_known: bool = True) -> DataFrame:
    """Patients that pass the steps; without ``events_known`` those that need no events."""
    later = set() if events_known else {"no_prior_outcome"} | ({"exclusion"} if study.exclusion_in == "events" else set())
    for name, condition in steps(study):
        if name not in later:
            patients = patients.filter(_holds(condition))
    return patients


def acceptable_cohort(patients: DataFrame, drugs: DataFrame, events: DataFrame | None, study: Study, early: bool = False) -> DataFrame:
    """Patients that pass every step, with exposure, study entry and outcome; ``early`` as in ``eligibility``."""
    kept = keep_eligible(eligibility(patients, drugs, events, study, early=early), study)
    return kept.drop("_last_excluded", "single_class")


def restrict_events(cohort: DataFrame, *tables: DataFrame) -> list[DataFrame]:
    """The cohort's rows of each event table. The cohort's keys are worked out once and stored."""
    keys = materialise(cohort.select("patid"))
    return [patient_semi(t, keys) for t in tables]


def attrition_table(patients: DataFrame, conditions: Sequence[tuple[str, Column]]) -> DataFrame:
    """(step_no, step, remaining, excluded) for conditions applied in turn, counted in one pass."""
    counts, passed = [F.count(F.lit(1)).alias("n0")], F.lit(True)
    for i, (_, condition) in enumerate(conditions, 1):
        passed = passed & _holds(condition)
        counts.append(F.count_if(passed).alias(f"n{i}"))
    names = ["all", *[name for name, _ in conditions]]
    rows = [
        x for i, name in enumerate(names)
        for x in (F.lit(i), F.lit(name), F.col(f"n{i}"), F.lit(0).cast("bigint") if i == 0 else F.col(f"n{i - 1}") - F.col(f"n{i}"))
    ]
    return patients.agg(*counts).select(F.stack(F.lit(len(names)), *rows).alias("step_no", "step", "remaining", "excluded"))


def cohort_attrition(patients: DataFrame, drugs: DataFrame, events: DataFrame | None, study: Study) -> DataFrame:
    return attrition_table(eligibility(patients, drugs, events, study), steps(study))


@dataclass
class Covariates:
    """Codelists of the covariates; ``units`` is the unit dictionary, ``ethnicity`` one row per patient."""

    medications: DataFrame
    medication_names: Sequence[str]
    conditions: DataFrame
    condition_names: Sequence[str]
    measurement: DataFrame
    units: DataFrame
    ethnicity: DataFrame
    treatment_codes: dict[str, int] | None = None
    measurement_unit: str = BMI_UNIT
    measurement_range: tuple[float, float] = (BMI_LOW, BMI_HIGH)


# Working columns that the finished dataset leaves out.
WORKING_COLUMNS = (
    "mob", "yob", "pracid", "acceptable", "emis_ddate", "regstartdate", "regenddate", "time_to_first_exposure", "index_date",
    "study_entry_date", "outcome_date", "study_exit_date", "censor_date", "last_exposure_date", "last_duration",
    "_last_excluded", "single_class", "drugsubstancename", "obsdate_BMI",
)


def research_dataset(
    patients: DataFrame, drugs: DataFrame, events: DataFrame, study: Study, covariates: Covariates, early: bool = False
) -> DataFrame:
    """One row per eligible patient: outcome within the study, treatment, age and all covariates; ``early`` as in ``eligibility``."""
    c = covariates
    measured = measurement_part(c.measurement, "BMI", *c.measurement_range)
    wide = eligibility(
        patients, drugs, with_unit(events, c.units, c.measurement_unit), study,
        [medication_part(c.medications, c.medication_names)],
        [condition_part(c.conditions, c.condition_names), measured], early,
    )
    cohort = keep_eligible(wide, study).withColumnRenamed("first_exposure_date", "index_date")
    cohort = censor_outcome(add_study_end(cohort, study.end))
    cohort = unpack_medications(cohort, c.medication_names, "study_entry_date", "index_date")
    cohort = unpack_conditions(conditions_found(cohort, c.condition_names), c.condition_names, "index_date")
    cohort = cohort.withColumn("age_at_exposure", age_at("index_date"))
    cohort = attach_ethnicity(unpack_measurement(cohort, "BMI"), c.ethnicity)
    cohort = cohort.withColumn("treatment", case_recode("drugsubstancename", c.treatment_codes or TREATMENT_CODES))
    return value_exclude(cohort, "gender", "3").drop(*WORKING_COLUMNS)
