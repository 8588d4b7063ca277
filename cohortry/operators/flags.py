"""0/1 flags and latest measurements per patient, from any number of codelists at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import forbid_columns
from ..functions.dates import effective_date, parse_dates
from .joins import broadcast_if_small, codelist_filter, fits
from .summaries import ON, ROLE, Part, in_role, prefixed, role, role_sql, summarise_events

MEDICATION, CONDITION = "medication:", "condition:"
MODES = ("earliest", "first_record")


def medication_part(lists: DataFrame, names: Sequence[str]) -> Part:
    """The distinct days of each patient on any of the lists: at most one entry per list and calendar day."""
    entry = F.struct(F.col(ROLE).alias("list"), F.col(ON).alias("on"))
    mine = in_role(*[MEDICATION + n for n in names]) & F.col(ON).isNotNull()
    return Part(prefixed(lists, MEDICATION), [F.collect_set(F.when(mine, entry)).alias("_days")])


def unpack_medications(patients: DataFrame, names: Sequence[str], start: str, end: str) -> DataFrame:
    def used(name):
        day = f"d.list = {role_sql(MEDICATION + name)} AND d.on BETWEEN `{start}` AND `{end}`"
        return F.expr(f"int(coalesce(exists(_days, d -> {day}), false))")

    return patients.withColumns({n: used(n) for n in names}).drop("_days")


def baseline_exposure_flags(
    patients: DataFrame, drugs: DataFrame, lists: DataFrame, names: Sequence[str],
    start: str = "study_entry_date", end: str = "index_date", code: str = "prodcodeid",
    dates: tuple[str, str] = ("issuedate", "enterdate"),
) -> DataFrame:
    """One 0/1 column per list: an issue from ``start`` to ``end`` of the patient, both included."""
    forbid_columns(patients, names, "patients")
    days = summarise_events(drugs, [medication_part(lists, names)], code, dates)
    return unpack_medications(patients.join(days, "patid", "left"), names, start, end)


def baseline_exposure_flag(patients: DataFrame, drugs: DataFrame, codes: DataFrame, name: str, **options) -> DataFrame:
    named = codes.select(F.lit(name).alias("list_name"), "code", "term")
    return baseline_exposure_flags(patients, drugs, named, [name], **options)


# Stands for the date of an undated event, so that one aggregate tells whether and when a condition occurs.
_UNDATED = "DATE '9999-12-31'"


def condition_part(lists: DataFrame, names: Sequence[str]) -> Part:
    """The earliest day of each condition."""
    return Part(prefixed(lists, CONDITION), [
        F.expr(f"min(CASE WHEN {ROLE} = {role_sql(CONDITION + n)} THEN coalesce({ON}, {_UNDATED}) END)").alias(f"_first_{n}")
        for n in names
    ])


def conditions_found(summary: DataFrame, names: Sequence[str]) -> DataFrame:
    """Flag 1 and date for each condition found, dated or not; nulls for the others."""
    found = summary.withColumns({
        **{f"obsdate_{n}": F.expr(f"nullif(`_first_{n}`, {_UNDATED})") for n in names},
        **{n: F.expr(f"CASE WHEN `_first_{n}` IS NOT NULL THEN 1 END") for n in names},
    })
    return found.drop(*[f"_first_{n}" for n in names])


def validate_condition_dates(patients: DataFrame, names: Sequence[str], reference: str) -> DataFrame:
    """A flag whose date is missing or later than the reference date becomes 0."""
    def checked(n):
        bad = f"coalesce(`obsdate_{n}` > `{reference}`, `obsdate_{n}` IS NULL)"
        return F.expr(f"CASE WHEN `{n}` = 1 AND {bad} THEN 0 ELSE `{n}` END")

    return patients.withColumns({n: checked(n) for n in names})


def earliest_condition(
    events: DataFrame, lists: DataFrame, names: Sequence[str], mode: str = "earliest", code: str = "medcodeid",
    dates: tuple[str, str] = ("obsdate", "enterdate"),
) -> DataFrame:
    """Per patient a flag and its date for each list.

    ``earliest`` dates the first event of the condition. ``first_record`` sets the flag only where the
    patient's first event of any kind (undated ones first) is of the condition.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    if mode == "earliest":
        return conditions_found(summarise_events(events, [condition_part(lists, names)], code, dates), names)
    rows = parse_dates(events.select("patid", code, *dates), *dates).withColumn("_on", effective_date(*dates))
    per_code = lists.groupBy("code").agg(F.collect_set("list_name").alias("_lists")).withColumnRenamed("code", code)
    rows = rows.join(broadcast_if_small(per_code), code, "left")

    def mine(n):
        return F.coalesce(F.array_contains("_lists", n), F.lit(False))

    summary = rows.groupBy("patid").agg(
        F.max(F.col("_on").isNull()).alias("_undated"), F.min("_on").alias("_first"),
        *[F.max(F.when(F.col("_on").isNull(), mine(n))).alias(f"_undated_{n}") for n in names],
        *[F.min(F.when(mine(n), F.col("_on"))).alias(f"_first_{n}") for n in names],
    )
    columns = []
    for n in names:
        dated = F.coalesce(F.col(f"_first_{n}") == F.col("_first"), F.lit(False))
        hit = F.when(F.col("_undated"), F.col(f"_undated_{n}")).otherwise(dated)
        columns += [
            F.when(hit & ~F.col("_undated"), F.col("_first")).alias(f"obsdate_{n}"),
            F.when(hit, F.lit(1)).alias(n),
        ]
    return summary.select("patid", *columns)


def condition_flags(
    patients: DataFrame, events: DataFrame, lists: DataFrame, names: Sequence[str], as_of: str = "index_date",
    mode: str = "earliest", code: str = "medcodeid", dates: tuple[str, str] = ("obsdate", "enterdate"),
) -> DataFrame:
    """One 0/1 column per condition: recorded on or before ``as_of``."""
    forbid_columns(patients, names, "patients")
    joined = patients.join(earliest_condition(events, lists, names, mode, code, dates), "patid", "left")
    return unpack_conditions(joined, names, as_of)


def unpack_conditions(patients: DataFrame, names: Sequence[str], as_of: str) -> DataFrame:
    valid = validate_condition_dates(patients.fillna(0, subset=list(names)), names, as_of)
    return valid.drop(*[f"obsdate_{n}" for n in names])


# Unit text and plausible range of the body mass index.
BMI_UNIT, BMI_LOW, BMI_HIGH = "kg/m2", 6.7, 70.0


IN_UNIT = "_in_unit"


def with_unit(events: DataFrame, units: DataFrame, text: str = BMI_UNIT) -> DataFrame:
    """``events`` with ``_in_unit``: true where the dictionary describes the event's unit by ``text``, else null.

    The dictionary is joined, not read while the plan is built; it may name a unit a few times.
    """
    ids = units.filter(F.col("Description") == text).select(F.col("numunitid").try_cast("int").alias("_unit"))
    unique = ids.distinct().withColumn(IN_UNIT, F.lit(True))
    if fits(ids):  # small with all repeats
        unique = F.broadcast(unique)
    return events.join(unique, F.col("numunitid").try_cast("int") == F.col("_unit"), "left").drop("_unit")


def _in_range(low: float, high: float):
    return F.col(IN_UNIT) & F.col("value").try_cast("double").between(low, high)


def measurement_part(codes: DataFrame, name: str = "BMI", low: float = BMI_LOW, high: float = BMI_HIGH) -> Part:
    """The latest in-range value, the larger one on ties; the events come from ``with_unit``."""
    label = f"measurement:{name}"
    record = F.struct(F.col(ON).alias("on"), F.col("value").try_cast("double").alias("value"))
    hit = in_role(label) & _in_range(low, high)
    return Part(role(codes, label), [F.max(F.when(hit, record)).alias(f"_latest_{name}")], ["value", IN_UNIT])


def unpack_measurement(patients: DataFrame, name: str = "BMI") -> DataFrame:
    latest = f"_latest_{name}"
    return patients.withColumns({f"obsdate_{name}": F.col(f"{latest}.on"), name: F.col(f"{latest}.value")}).drop(latest)


def latest_measurement(
    events: DataFrame, codes: DataFrame | None, units: DataFrame, name: str = "BMI", unit: str = BMI_UNIT,
    low: float = BMI_LOW, high: float = BMI_HIGH, patients: DataFrame | None = None, as_of: str | None = None,
    code: str = "medcodeid", dates: tuple[str, str] = ("obsdate", "enterdate"),
) -> DataFrame:
    """(patid, obsdate_<name>, <name>): the latest value from ``low`` to ``high`` in the unit, the larger one on ties.

    ``codes`` None takes every code. With ``as_of``, a date column of ``patients``, only values up to
    that date count; the values of a patient are first reduced to one per day.
    """
    events = with_unit(events, units, unit)
    if codes is not None and as_of is None:
        summary = summarise_events(events, [measurement_part(codes, name, low, high)], code, dates)
        return unpack_measurement(summary, name).filter(F.col(name).isNotNull())
    rows = parse_dates(events.select("patid", code, *dates, "value", IN_UNIT), *dates).filter(_in_range(low, high))
    if codes is not None:
        rows = codelist_filter(rows, codes, code)
    rows = rows.groupBy("patid", effective_date(*dates).alias("on")).agg(F.max(F.col("value").try_cast("double")).alias("value"))
    if as_of is not None:
        if patients is None:
            raise ValueError("as_of needs the patients that carry it")
        rows = rows.join(patients.select("patid", F.col(as_of).alias("_as_of")), "patid").filter("on <= _as_of")
    summary = rows.groupBy("patid").agg(F.max(F.struct("on", "value")).alias(f"_latest_{name}"))
    return unpack_measurement(summary, name)
