"""Balance between groups: standardised mean differences and the summary table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import chi2_p, f_p
from .association import anova, chi_square
from .describe import missing_percent
from .groups import OVERALL, level_counts, level_pairs, moments, only_groups, overall_moments, pair_up


def _numeric_smd(df: DataFrame, group: str, names: Sequence[str], pairs) -> DataFrame:
    wide = pair_up(moments(only_groups(df, group, pairs), names, group), ["variable"], ["mean", "var"], pairs)
    pooled = F.sqrt((F.col("var1") + F.col("var2")) / 2)
    return wide.select("variable", "group1", "group2", F.when(pooled > 0, (F.col("mean2") - F.col("mean1")) / pooled).alias("smd"))


def smd_numeric(df: DataFrame, group: str, names: Sequence[str], pairs: Sequence[tuple] | None = None) -> DataFrame:
    """(variable, group1, group2, smd): difference of means over the pooled deviation, without sign; null if that is 0."""
    return _numeric_smd(df, group, names, pairs).withColumn("smd", F.abs("smd"))


def _shares(df: DataFrame, group: str, names: Sequence[str], pairs) -> DataFrame:
    """(variable, level, group1, group2, p1, p2): shares of each level; 0 where a group lacks it."""
    rows = level_pairs(level_counts(only_groups(df, group, pairs), names, group), pairs)

    def share(n, t):
        return F.when(F.col(t) > 0, F.col(n) / F.col(t)).otherwise(F.lit(0.0))

    return rows.select("variable", "level", "group1", "group2", share("n1", "t1").alias("p1"), share("n2", "t2").alias("p2"))


def smd_categorical(df: DataFrame, group: str, names: Sequence[str], pairs: Sequence[tuple] | None = None) -> DataFrame:
    """(variable, level, group1, group2, smd) for every level, of two-valued columns too."""
    spread = (F.col("p1") * (1 - F.col("p1")) + F.col("p2") * (1 - F.col("p2"))) / 2
    smd = F.when(spread > 0, F.abs(F.col("p1") - F.col("p2")) / F.sqrt(spread))
    return _shares(df, group, names, pairs).select("variable", "level", "group1", "group2", smd.alias("smd"))


smd_binary = smd_categorical


def smd_multilevel(df: DataFrame, group: str, names: Sequence[str], pairs: Sequence[tuple] | None = None) -> DataFrame:
    """(variable, group1, group2, smd): one distance over all levels; null if a group lacks a level.

    The distance is d' S^-1 d with d the difference of the share vectors, one level left out, and S
    the mean of both multinomial covariances. S is diagonal minus two rank-one terms, so its inverse
    needs only sums over the levels.
    """
    shares = _shares(df, group, names, pairs)
    keys = ["variable", "group1", "group2"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("level"))
    rows = shares.withColumn("_place", place)
    p, q = F.col("p1"), F.col("p2")
    mid, diff, used = (p + q) / 2, q - p, (F.col("_place") > 1) & (p + q > 0)

    def total(expression):
        return F.sum(F.when(used, expression / mid))

    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("levels"), F.min(F.least(p, q)).alias("least"), total(diff * diff).alias("dd"),
        (total(p * diff) / F.sqrt(F.lit(2.0))).alias("v1"), (total(q * diff) / F.sqrt(F.lit(2.0))).alias("v2"),
        (1 - total(p * p) / 2).alias("k11"), (-total(p * q) / 2).alias("k12"), (1 - total(q * q) / 2).alias("k22"),
    )
    det = F.col("k11") * F.col("k22") - F.col("k12") * F.col("k12")
    extra = (
        F.col("v1") * F.col("v1") * F.col("k22") - 2 * F.col("v1") * F.col("v2") * F.col("k12")
        + F.col("v2") * F.col("v2") * F.col("k11")
    ) / det
    ok = (F.col("levels") > 1) & (F.col("least") > 0) & (F.abs(det) > 0)
    return sums.select(*keys, F.when(ok, F.sqrt(F.col("dd") + extra)).alias("smd"))


def smd_pairs(
    df: DataFrame, group: str, continuous: Sequence[str] = (), categorical: Sequence[str] = (),
    pairs: Sequence[tuple] | None = None,
) -> DataFrame:
    """(variable, group1, group2, smd): continuous columns signed, second group minus first; others one distance."""
    return _numeric_smd(df, group, continuous, pairs).unionByName(smd_multilevel(df, group, categorical, pairs))


def table_one(df: DataFrame, group: str, categorical: Sequence[str], continuous: Sequence[str]) -> DataFrame:
    """(variable, level, grp, overall, n, percent, mean, sd, missing), each group and ``Overall``.

    The total has ``overall`` true, which tells it from a group of that name. A level has its count and its percent among the group's known values; a continuous column its
    mean and deviation. ``missing`` counts the column's nulls over all rows.
    """
    known = df.filter(F.col(group).isNotNull())
    counts = level_counts(known, categorical, group)
    total = counts.groupBy("variable", "level").agg(F.sum("n").alias("n")).withColumns({"grp": F.lit(OVERALL), "overall": F.lit(True)})
    counts = counts.withColumn("overall", F.lit(False)).unionByName(total)
    total = F.sum("n").over(Window.partitionBy("variable", "grp", "overall"))
    levels = counts.select(
        "variable", "level", "grp", "overall", "n", (F.col("n") * 100.0 / total).alias("percent"),
        F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("sd"),
    )
    spread = moments(known, continuous, group)
    spread = spread.withColumn("overall", F.lit(False)).unionByName(overall_moments(spread).withColumn("overall", F.lit(True)))
    means = spread.select(
        "variable", F.lit(None).cast("string").alias("level"), "grp", "overall", "n", F.lit(None).cast("double").alias("percent"),
        "mean", F.sqrt("var").alias("sd"),
    )
    nulls = missing_percent(known, [*categorical, *continuous]).select("variable", "missing")
    # One row per column of the table.
    return levels.unionByName(means).join(F.broadcast(nulls), "variable")


def table_one_tests(df: DataFrame, group: str, categorical: Sequence[str], continuous: Sequence[str]) -> DataFrame:
    """(variable, test, statistic, dof1, dof2, p_value): chi-square for levels, one-way F for means."""
    chi = chi_square(level_counts(df, categorical, group), ["variable"]).select(
        "variable", F.lit("chi-square").alias("test"), "statistic", F.col("dof").alias("dof1"),
        F.lit(None).cast("bigint").alias("dof2"), chi2_p("statistic", "dof").alias("p_value"),
    )
    f = anova(moments(df, continuous, group)).select(
        "variable", F.lit("one-way F").alias("test"), "statistic", "dof1", "dof2", f_p("statistic", "dof1", "dof2").alias("p_value")
    )
    return chi.unionByName(f)
