"""First and last records, running dates, flags of single events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_if_small


def _edge_record(events: DataFrame, keys: Sequence[str], date: str, latest: bool) -> DataFrame:
    """One whole record per key, by date and then by all other columns; undated records come last.

    An aggregate rather than a ranking window: each task keeps one record per key before the
    shuffle, so a key with very many records costs no more than any other.
    """
    rest = [c for c in events.columns if c not in keys and c != date]
    if latest:
        chosen = F.max(F.struct(date, *rest))
    else:
        chosen = F.min(F.struct(F.col(date).isNull().alias("_undated"), date, *rest))
    return events.groupBy(*keys).agg(chosen.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in events.columns]
    )


def first_event(events: DataFrame, date: str, keys: Sequence[str] = ("patid",)) -> DataFrame:
    return _edge_record(events, keys, date, latest=False)


def last_event(events: DataFrame, date: str, keys: Sequence[str] = ("patid",)) -> DataFrame:
    return _edge_record(events, keys, date, latest=True)


def first_per_class(events: DataFrame, date: str, term: str = "drugsubstancename", key: str = "patid") -> DataFrame:
    return _edge_record(events, (key, term), date, latest=False)


def running_dates(events: DataFrame, date: str, keys: Sequence[str] = ("patid",)) -> DataFrame:
    """Per key and distinct day: rank of the day, days so far, records so far.

    Records are first counted per day, so the window sees at most one row per calendar day of a key.
    """
    days = events.groupBy(*keys, date).agg(F.count(F.lit(1)).alias("records"))
    so_far = Window.partitionBy(*keys).orderBy(date)
    return days.select(
        *keys, date, "records",
        F.dense_rank().over(so_far).cast("bigint").alias("date_rank"),
        F.max(date).over(so_far).alias("latest_so_far"),
        F.sum("records").over(so_far).alias("records_so_far"),
    )


def first_appearances(events: DataFrame, date: str, value: str, keys: Sequence[str] = ("patid",)) -> DataFrame:
    """(keys, value, since, place): the day each value of a key is first seen, and its place in that order.

    Values seen first on one day are in their own order. Events without a day or a value are left out. The
    window sees each value of a key once, however many events it has.
    """
    seen = events.filter(F.col(date).isNotNull() & F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(date).alias("since"))
    return seen.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("since", value)).cast("bigint"))


def running_counts(events: DataFrame, date: str, value: str, keys: Sequence[str] = ("patid",)) -> DataFrame:
    """(keys, date, values_so_far) for every day of a key: the set of values at that day is the places up to
    this number in ``first_appearances``, so nothing is kept twice and sizes do not grow with the square."""
    per_value = events.filter(F.col(date).isNotNull()).groupBy(*keys, value).agg(F.min(date).alias("_since"))
    new = per_value.filter(F.col(value).isNotNull()).groupBy(*keys, F.col("_since").alias(date)).agg(F.count(F.lit(1)).alias("_new"))
    days = events.filter(F.col(date).isNotNull()).select(*keys, date).distinct().join(new, [*keys, date], "left")
    so_far = Window.partitionBy(*keys).orderBy(date)
    return days.select(*keys, date, F.coalesce(F.sum("_new").over(so_far), F.lit(0)).alias("values_so_far"))


def running_sets(events: DataFrame, date: str, value: str, keys: Sequence[str] = ("patid",)) -> DataFrame:
    """(keys, date, seen): the values up to each day as a list in order of first appearance, written out.

    The lists themselves grow with the square of a key's values; ``first_appearances`` and ``running_counts``
    say the same without.
    """
    order = F.sort_array(F.collect_list(F.struct("place", value)))
    lists = first_appearances(events, date, value, keys).groupBy(*keys).agg(order.alias("_all"))
    joined = running_counts(events, date, value, keys).join(lists, list(keys), "left")
    all_values = F.coalesce(F.col(f"_all.{value}"), F.array().cast(f"array<{events.schema[value].dataType.simpleString()}>"))
    return joined.select(*keys, date, F.slice(all_values, F.lit(1), F.col("values_so_far").cast("int")).alias("seen"))


def condition_flag(events: DataFrame, codes: DataFrame, name: str, code: str = "medcodeid", date: str = "obsdate") -> DataFrame:
    """Every event with a 0/1 column ``name`` and its date renamed to ``obsdate_<name>``; the code goes."""
    keys = broadcast_if_small(codes.select(F.col("code").alias(code)).distinct().withColumn(name, F.lit(1)))
    flagged = events.join(keys, code, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return flagged.drop(code).withColumnRenamed(date, f"obsdate_{name}")


def events_before_index(
    events: DataFrame, patients: DataFrame, days: int, date: str, index: str = "index_date", key: str = "patid"
) -> DataFrame:
    """Events of the ``days`` days up to the patient's index date, that day and the first one included."""
    # The patients may be the end of long work: a plain join, with no size check that would run it.
    rows = events.join(patients.select(key, index), key)
    inside = F.col(date).between(F.date_sub(F.col(index), days), F.col(index))
    return rows.filter(inside).select(*events.columns)
