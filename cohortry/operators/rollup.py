"""Events rolled up to one row per patient: dates per codelist, value summaries per code, categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import period_filter
from .joins import acceptable_join, broadcast_if_small, full_outer_fold, tag_events

KEY, CODE, DATE, VALUE = "PatientIdentifier", "CodeId", "EffectiveDate", "Value"


def baseline_events(events: DataFrame, start, end, shift_days: int = 0, date: str = DATE) -> DataFrame:
    """Events in the period, both of whose ends are moved back by ``shift_days``."""
    lo, hi = F.date_sub(F.lit(start).cast("date"), shift_days), F.date_sub(F.lit(end).cast("date"), shift_days)
    return events.filter(F.col(date).between(lo, hi))


def rollup_codes(
    events: DataFrame, lists: DataFrame, names: Sequence[str], start, end, shift_days: int = 0, key: str = KEY
) -> DataFrame:
    """Per patient and list: sorted distinct dates, latest, earliest, and 1; nulls where the list has no event.

    A list of distinct dates is bounded by the days of the period.
    """
    rows = tag_events(baseline_events(events, start, end, shift_days), lists, CODE)
    aggregates = []
    for n in names:
        day = F.when(F.col("list_name") == n, F.col(DATE))
        dates = F.sort_array(F.collect_set(day))
        aggregates += [
            F.when(F.size(dates) > 0, dates).alias(f"timestamps@[{n}]"),
            F.max(day).alias(f"latest@[{n}]"), F.min(day).alias(f"earliest@[{n}]"),
            F.max(F.when(F.col("list_name") == n, F.lit(1))).alias(f"[{n}]"),
        ]
    return rows.groupBy(key).agg(*aggregates)


def value_events(events: DataFrame, codes: Sequence[str], start=None, end=None) -> DataFrame:
    """Events of the codes in the period; an event without a value counts as 1."""
    rows = period_filter(events, DATE, start, end).filter(F.col(CODE).isin(list(codes)))
    return rows.withColumn(VALUE, F.coalesce(F.col(VALUE).try_cast("double"), F.lit(1.0)))


def rollup_values(events: DataFrame, codes: Sequence[str], start=None, end=None, key: str = KEY) -> DataFrame:
    """Per patient and code the mean, largest and smallest value; the values themselves are in ``value_timeline``."""
    rows = value_events(events, codes, start, end)
    aggregates = []
    for c in codes:
        mine = F.when(F.col(CODE) == c, F.col(VALUE))
        aggregates += [F.avg(mine).alias(f"mean@{c}"), F.max(mine).alias(f"max@{c}"), F.min(mine).alias(f"min@{c}")]
    return rows.groupBy(key).agg(*aggregates)


def value_timeline(events: DataFrame, codes: Sequence[str], start=None, end=None, key: str = KEY) -> DataFrame:
    """(patient, code, date, value, copies): the distinct values of each day and how often each occurs.

    The list of a patient's values in long form: its shape does not depend on how many there are, and no
    row grows with the data. Sorted by date and value it is the timeline. Undated events have a null date.
    """
    return value_events(events, codes, start, end).groupBy(key, CODE, DATE, VALUE).agg(F.count(F.lit(1)).alias("copies"))


def rollup_category(events: DataFrame, terms: DataFrame, key: str = KEY, name: str = "category") -> DataFrame:
    """Per patient the latest date with a code of the category, and the term recorded then.

    ``terms`` holds the category's codes with their terms.
    """
    last = F.max(F.struct(DATE, "term")).alias("_last")
    return _with_terms(events, terms, key).groupBy(key).agg(last).select(
        key, F.col(f"_last.{DATE}").alias(f"latest@{name}"), F.col("_last.term").alias(f"term@{name}")
    )


def category_entries(events: DataFrame, terms: DataFrame, key: str = KEY) -> DataFrame:
    """(patient, entry): the set of ``term@value`` texts of each patient, one row an entry."""
    text = F.concat("term", F.lit("@"), F.coalesce(F.col(VALUE).cast("string"), F.lit("")))
    return _with_terms(events, terms, key).select(key, text.alias("entry")).distinct()


def _with_terms(events: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    codes = terms.select(F.col("code").alias(CODE), "term").groupBy(CODE).agg(F.min("term").alias("term"))
    return events.select(key, CODE, DATE, VALUE).join(broadcast_if_small(codes), CODE)


def cross_section(
    patients: DataFrame, rollups: Sequence[DataFrame], key: str = KEY, demographics: Sequence[str] = ("Sex", "YearOfBirth", "DateOfDeath"),
    flag: str = "IsAcceptable",
) -> DataFrame:
    """One row per acceptable patient found in any roll-up, with all their columns and the demographics."""
    wide = acceptable_join(full_outer_fold(rollups, key), patients, key, flag)
    return wide.join(patients.select(key, *demographics), key, "left")


def relevant_records(
    events: DataFrame, pairs: DataFrame, start, end, extra: DataFrame | None = None, key: str = KEY
) -> DataFrame:
    """Distinct raw events, in the period, of the given (patient, code) pairs, and the ``extra`` events.

    The pairs come first, so that only their events are shuffled to find copies.
    """
    rows = period_filter(events, DATE, start, end)
    kept = rows.join(pairs.select(key, CODE).distinct(), [key, CODE], "left_semi").select(*events.columns)
    return (kept if extra is None else kept.unionByName(extra.select(*events.columns))).distinct()
