"""Tests of association: chi-square, Welch t, one-way F. All start from small tables of counts or moments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import chi2_p, t_p
from .groups import group_totals, level_counts, level_pairs, moments, only_groups, pair_up


def chi_square(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, statistic, dof, n) of independence between ``level`` and ``grp``, without continuity correction.

    Cells without rows are not in ``counts``; each adds its expected count, which is what the others leave over.
    """
    keys = list(keys)
    # Margins from small aggregates, as doubles: their product passes 64 bits for a few billion rows.
    rows = counts.groupBy(*keys, "level").agg(F.sum("n").cast("double").alias("_row"))
    columns = counts.groupBy(*keys, "grp").agg(F.sum("n").cast("double").alias("_col"))
    everything = counts.groupBy(*keys).agg(F.sum("n").alias("_all"))
    cells = counts.join(rows, [*keys, "level"]).join(columns, [*keys, "grp"]).join(everything, keys)
    cells = cells.withColumn("_exp", F.col("_row") * F.col("_col") / F.col("_all"))
    sums = cells.groupBy(*keys).agg(
        F.sum((F.col("n") - F.col("_exp")) * (F.col("n") - F.col("_exp")) / F.col("_exp")).alias("_filled"),
        F.sum("_exp").alias("_expected"), F.max("_all").alias("n"), F.count(F.lit(1)).alias("_cells"),
        F.count_distinct("level").alias("_rows"), F.count_distinct("grp").alias("_cols"),
    )
    empty = F.when(F.col("_cells") < F.col("_rows") * F.col("_cols"), F.col("n") - F.col("_expected")).otherwise(F.lit(0.0))
    return sums.select(
        *keys, (F.col("_filled") + empty).alias("statistic"), ((F.col("_rows") - 1) * (F.col("_cols") - 1)).alias("dof"), "n"
    )


def chi_square_pairs(df: DataFrame, group: str, names: Sequence[str], pairs: Sequence[tuple] | None = None) -> DataFrame:
    """(variable, group1, group2, statistic, dof, p_value) of each column within each pair of groups."""
    counts = level_counts(only_groups(df, group, pairs), names, group)
    keys = ["variable", "group1", "group2"]
    # Levels that both groups have are met level by level; what the others add depends on the totals only.
    both = pair_up(counts, ["variable", "level"], ["n"], pairs)
    whole = pair_up(group_totals(counts), ["variable"], ["t", "levels"], pairs)
    n1, n2, t1, t2 = (F.col(c).cast("double") for c in ("n1", "n2", "t1", "t2"))
    apart = n1 * t2 - n2 * t1
    shared = both.join(whole.select(*keys, "t1", "t2"), keys).groupBy(*keys).agg(
        F.sum(apart * apart / ((n1 + n2) * t1 * t2)).alias("_shared"), F.sum("n1").alias("_n1"), F.sum("n2").alias("_n2"), F.count(F.lit(1)).alias("_both")
    )
    none = F.lit(0)
    tested = whole.join(shared, keys, "left").select(
        *keys,
        (F.coalesce("_shared", F.lit(0.0)) + (t1 - F.coalesce("_n1", none)) * t2 / t1 + (t2 - F.coalesce("_n2", none)) * t1 / t2).alias("statistic"),
        (F.col("levels1") + F.col("levels2") - F.coalesce("_both", none) - 1).alias("dof"),
    )
    return tested.select(*keys, "statistic", "dof", chi2_p("statistic", "dof").alias("p_value"))


def chi_square_by_stratum(df: DataFrame, stratum: str, group: str, pairs: Sequence[tuple] | None = None) -> DataFrame:
    """(stratum, group1, group2, statistic, dof, p_value): this stratum against the rest, one group against the other."""
    wide = level_pairs(level_counts(only_groups(df, group, pairs), [stratum], group), pairs)
    a, b = F.col("n1"), F.col("n2")
    c, d = F.col("t1") - a, F.col("t2") - b
    cross = a * d - b * c
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    statistic = F.when(margins > 0, (a + b + c + d) * cross * cross / margins)
    out = wide.select(F.col("level").alias("stratum"), "group1", "group2", statistic.alias("statistic"), F.lit(1).cast("bigint").alias("dof"))
    return out.withColumn("p_value", chi2_p("statistic", "dof"))


def welch_t_pairs(df: DataFrame, group: str, names: Sequence[str], pairs: Sequence[tuple] | None = None) -> DataFrame:
    """(variable, group1, group2, statistic, dof, p_value): two-sided t test with unequal variances."""
    wide = pair_up(moments(only_groups(df, group, pairs), names, group), ["variable"], ["n", "mean", "var"], pairs)
    a, b = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    error = a + b
    out = wide.select(
        "variable", "group1", "group2", F.when(error > 0, (F.col("mean1") - F.col("mean2")) / F.sqrt(error)).alias("statistic"),
        F.when(error > 0, error * error / (a * a / (F.col("n1") - 1) + b * b / (F.col("n2") - 1))).alias("dof"),
    )
    return out.withColumn("p_value", t_p("statistic", "dof"))


def anova(spread: DataFrame) -> DataFrame:
    """(variable, statistic, dof1, dof2) of the one-way F test, from the moments of each group."""
    n, m = F.col("n"), F.col("mean")
    rows = spread.filter("n > 0").withColumn("_grand", F.sum(n * m).over(Window.partitionBy("variable")) / F.sum(n).over(Window.partitionBy("variable")))
    sums = rows.groupBy("variable").agg(
        F.sum(n * (m - F.col("_grand")) * (m - F.col("_grand"))).alias("between"),
        F.sum((n - 1) * F.coalesce("var", F.lit(0.0))).alias("within"),
        (F.count(F.lit(1)) - 1).alias("dof1"), (F.sum(n) - F.count(F.lit(1))).alias("dof2"),
    )
    ok = (F.col("dof1") > 0) & (F.col("dof2") > 0) & (F.col("within") > 0)
    f = (F.col("between") / F.col("dof1")) / (F.col("within") / F.col("dof2"))
    return sums.select("variable", F.when(ok, f).alias("statistic"), "dof1", "dof2")
