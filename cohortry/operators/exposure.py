"""First and last exposure to a drug list, and study windows that follow from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import forbid_columns, require_columns
from ..functions.dates import as_date, birthday_bound, days_between, pack_last, unpack_last
from .summaries import TERM, Part, in_role, role, summarise_events

EXPOSURE = "exposure"
PROFILE = ("first_exposure_date", "drugsubstancename", "single_class", "last_exposure_date", "last_duration")


def exposure_part(codes: DataFrame, date: str = "issuedate", duration: str | None = "duration") -> Part:
    """First dated issue with its substance, last issue with its duration, and whether only one substance occurs.

    Same-day ties: the first substance by name, the longest duration. One substance in all means
    that the smallest and largest name are equal, which needs no distinct count.
    """
    mine = in_role(EXPOSURE)
    issue = F.struct(F.col(date).alias("on"), F.col(TERM).alias("term"))
    last = pack_last(F.col(date), F.col(duration).try_cast("int") if duration else F.lit(None).cast("int"))
    return Part(
        role(codes, EXPOSURE),
        [
            F.min(F.when(mine & F.col(date).isNotNull(), issue)).alias("_first"),
            F.max(F.when(mine & F.col(date).isNotNull(), last)).alias("_last"),
            (F.min(F.when(mine, F.col(TERM))) == F.max(F.when(mine, F.col(TERM)))).alias("single_class"),
        ],
        [duration] if duration else [],
    )


def unpack_exposure(summary: DataFrame) -> DataFrame:
    last_day, last_duration = unpack_last(F.col("_last"))
    return summary.withColumns({
        "first_exposure_date": F.col("_first.on"), "drugsubstancename": F.col("_first.term"),
        "last_exposure_date": last_day, "last_duration": last_duration,
    }).drop("_first", "_last")


def exposure_profile(
    drugs: DataFrame, codes: DataFrame, date: str = "issuedate", code: str = "prodcodeid", duration: str | None = "duration"
) -> DataFrame:
    part = exposure_part(codes, date, duration)
    return unpack_exposure(summarise_events(drugs, [part], code, [date])).select("patid", *PROFILE)


def with_time_to_exposure(patients: DataFrame) -> DataFrame:
    return patients.withColumn("regstartdate", as_date(patients, "regstartdate")).withColumn(
        "time_to_first_exposure", days_between("first_exposure_date", "regstartdate")
    )


def add_first_exposure(
    patients: DataFrame, drugs: DataFrame, codes: DataFrame, date_col: str = "issuedate", code: str = "prodcodeid"
) -> DataFrame:
    """Patients with date and substance of the first issue and the days from registration to it.

    Patients never exposed stay, with nulls.
    """
    require_columns(drugs, [code, "patid", date_col], "drugs")
    require_columns(patients, ["patid", "regstartdate"], "patients")
    require_columns(codes, ["code", "term"], "codes")
    forbid_columns(patients, ["first_exposure_date", "drugsubstancename"], "patients")
    first = exposure_profile(drugs, codes, date_col, code, None).select("patid", "first_exposure_date", "drugsubstancename")
    return with_time_to_exposure(patients.join(first, "patid", "left"))


def require_lookback(patients: DataFrame, days: int = 365) -> DataFrame:
    """At least ``days`` of registration before the first exposure; adds the study entry date."""
    return with_study_entry(patients.filter(F.col("time_to_first_exposure") >= days), days)


def with_study_entry(patients: DataFrame, days: int = 365) -> DataFrame:
    return patients.withColumn("study_entry_date", F.date_sub("first_exposure_date", days))


def require_period(patients: DataFrame, start, end) -> DataFrame:
    """First exposure within the study period, both ends included."""
    return patients.filter(F.col("first_exposure_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def require_adult(patients: DataFrame, years: int = 18) -> DataFrame:
    return patients.filter(F.col("first_exposure_date") >= birthday_bound("yob", years))


def require_single_class(patients: DataFrame, drugs: DataFrame, codes: DataFrame, code: str = "prodcodeid") -> DataFrame:
    """Patients with issues of exactly one substance of the list, at any time, dated or not."""
    single = exposure_profile(drugs, codes, code=code, duration=None).filter("single_class").select("patid")
    return patients.join(single, "patid", "left_semi")


def single_class_patients(drugs: DataFrame, codes: DataFrame, code: str = "prodcodeid") -> DataFrame:
    profile = exposure_profile(drugs, codes, code=code, duration=None)
    return profile.filter("single_class").select("patid", "drugsubstancename")


def add_study_end(
    patients: DataFrame, study_end, drugs: DataFrame | None = None, codes: DataFrame | None = None,
    grace: int = 120, default: int = 180, code: str = "prodcodeid",
) -> DataFrame:
    """Censor date and the date at which each patient leaves the study.

    Censoring is the last issue plus its duration and ``grace`` days, or plus ``default`` days where
    the duration is no whole number. The study ends at the first of death, end of registration, end
    of study, outcome and censoring; missing dates do not count. Patients that already carry the
    last exposure are not joined again.
    """
    if "last_exposure_date" not in patients.columns:
        last = exposure_profile(drugs, codes, code=code).select("patid", "last_exposure_date", "last_duration")
        patients = patients.join(last, "patid", "left")
    after = F.coalesce(F.col("last_duration") + grace, F.lit(default))
    dated = patients.withColumns({
        "censor_date": F.date_add("last_exposure_date", after),
        **{c: as_date(patients, c) for c in ("emis_ddate", "regenddate", "outcome_date")},
    })
    leaves = F.least("emis_ddate", "regenddate", F.lit(study_end).cast("date"), "outcome_date", "censor_date")
    return dated.withColumn("study_exit_date", leaves)


def censor_outcome(patients: DataFrame) -> DataFrame:
    """An outcome after the end of study counts as none."""
    late = F.coalesce(F.col("outcome_date") > F.col("study_exit_date"), F.lit(False))
    return patients.withColumns({
        "outcome": F.when(late, F.lit(0)).otherwise(F.col("outcome")),
        "outcome_date": F.when(~late, F.col("outcome_date")),
    })
