"""Which treatments patients start with, how many they use, and in what order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import parse_dates
from .joins import codelist_filter

TERM = "drugsubstancename"


def exposures(drugs: DataFrame, codes: DataFrame, date: str = "issuedate", code: str = "prodcodeid") -> DataFrame:
    """(patid, date, substance) of every listed issue."""
    rows = parse_dates(drugs.select("patid", code, date), date)
    return codelist_filter(rows, codes, code, TERM).select("patid", date, TERM)


def percent_of_total(counts: DataFrame, count: str = "count", by: tuple[str, ...] = ()) -> DataFrame:
    """Share of each row in the total, or in the total of its ``by`` group. For result tables, one row per class."""
    total = F.sum(count).over(Window.partitionBy(*by))
    return counts.withColumn("percent", F.col(count) * 100.0 / total)


def first_treatment_share(profile: DataFrame) -> DataFrame:
    """Patients and percent by the first word of the substance they started with."""
    first = profile.filter(F.col(TERM).isNotNull()).select(F.split(TERM, r"\s+")[0].alias("treatment"))
    return percent_of_total(first.groupBy("treatment").agg(F.count(F.lit(1)).alias("count")))


def classes_per_patient_hist(rows: DataFrame) -> DataFrame:
    """Patients and percent by the number of different substances they ever had."""
    pairs = rows.select("patid", TERM).distinct()
    per_patient = pairs.groupBy("patid").agg(F.count(TERM).alias("classes"))
    return percent_of_total(per_patient.groupBy("classes").agg(F.count(F.lit(1)).alias("count")))


def subgroup_percent(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Rows per pair of values, and percent within the outer value."""
    counts = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("count"))
    return percent_of_total(counts, by=(outer,))


def treatment_sequence(rows: DataFrame, date: str = "issuedate") -> DataFrame:
    """(patid, prescribing_pattern, length, letters): the first issue, each change of substance, the last issue.

    Issues count in order of date and substance; undated ones have no place in a sequence. They are
    first counted per day and substance, so the list of one patient is bounded by calendar days. The
    last issue is always kept, also right after an equal one, hence the repeat where the final entry
    stands for several issues.
    """
    days = rows.filter(F.col(date).isNotNull()).groupBy("patid", date, TERM).agg(F.count(F.lit(1)).alias("issues"))
    lists = days.groupBy("patid").agg(F.array_sort(F.collect_list(F.struct(date, TERM, "issues"))).alias("days"))
    last = F.element_at("days", -1)
    size = F.size("days")

    def before(position):
        return F.get("days", position)[TERM]

    def kept(day, i):
        return (i == 0) | (i == size - 1) | ~day[TERM].eqNullSafe(before(i - 1))

    repeats = (last["issues"] > 1) & ((size == 1) | ~last[TERM].eqNullSafe(before(size - 2)))
    tail = F.when(repeats, F.array(last)).otherwise(F.slice("days", 1, 0))
    pattern = F.transform(F.concat(F.filter("days", kept), tail), lambda d: F.struct(d[date].alias(date), d[TERM].alias(TERM)))
    out = lists.select("patid", pattern.alias("prescribing_pattern"))
    letters = F.transform("prescribing_pattern", lambda d: F.lower(F.substring(d[TERM], 1, 1)))
    return out.withColumns({"length": F.size("prescribing_pattern"), "letters": letters})


def sequence_counts(sequences: DataFrame) -> DataFrame:
    """(letters, count, list_length) for every pattern of first letters."""
    counts = sequences.groupBy("letters").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("list_length", F.size("letters"))


def top_patterns(counts: DataFrame, limit: int = 20) -> DataFrame:
    """The most frequent patterns, ties in order of the pattern."""
    return counts.orderBy(F.desc("count"), "letters").limit(limit)
