"""Per-group counts and moments, the small tables that all comparisons start from.

Pairs of groups are made by a self-join of such a table over blocks of groups: every group belongs to one
block by a hash of its name, and each pair of blocks (i <= j) is a join key of its own. So a key compares
two bounded blocks, no row holds a list of groups, no name of a group comes to the driver, and the number
of groups has no limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OVERALL = "Overall"
# Groups of a block on average; results do not depend on it.
BLOCK_GROUPS = 256
Pairs = Sequence[tuple] | None


def number(name: str) -> Column:
    """A column as a double; what is not a number counts as missing."""
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


def moments(df: DataFrame, names: Sequence[str], by: str) -> DataFrame:
    """(variable, grp, n, mean, var) of numeric columns, from one aggregate over the groups."""
    if not names:
        return df.sparkSession.createDataFrame([], "grp string, variable string, n bigint, mean double, var double")
    aggregates = []
    for i, c in enumerate(names):
        x = number(c)
        aggregates += [F.count(x).alias(f"n_{i}"), F.avg(x).alias(f"m_{i}"), F.var_samp(x).alias(f"v_{i}")]
    wide = df.filter(F.col(by).isNotNull()).groupBy(F.col(by).cast("string").alias("grp")).agg(*aggregates)
    rows = [x for i, c in enumerate(names) for x in (F.lit(c), *(F.col(f"{k}_{i}") for k in "nmv"))]
    return wide.select("grp", F.stack(F.lit(len(names)), *rows).alias("variable", "n", "mean", "var"))


def overall_moments(spread: DataFrame) -> DataFrame:
    """Moments of all groups together, from those of each group."""
    n, m, whole = F.col("n"), F.col("mean"), Window.partitionBy("variable")
    rows = spread.filter("n > 0").withColumn("_all", F.sum(n * m).over(whole) / F.sum(n).over(whole))
    shift = m - F.col("_all")
    total = F.sum("n").alias("n")
    squares = F.sum((n - 1) * F.coalesce("var", F.lit(0.0)) + n * shift * shift)
    out = rows.groupBy("variable").agg(total, F.max("_all").alias("mean"), squares.alias("_squares"))
    var = F.when(F.col("n") > 1, F.col("_squares") / (F.col("n") - 1))
    return out.select(F.lit(OVERALL).alias("grp"), "variable", "n", "mean", var.alias("var"))


def level_counts(df: DataFrame, names: Sequence[str], by: str) -> DataFrame:
    """(variable, level, grp, n) for all columns in one scan, missing levels and groups left out."""
    if not names:
        return df.sparkSession.createDataFrame([], "variable string, level string, grp string, n bigint")
    texts = df.filter(F.col(by).isNotNull()).select(
        F.col(by).cast("string").alias("grp"), *[F.col(f"`{c}`").cast("string").alias(f"c_{i}") for i, c in enumerate(names)]
    )
    rows = [x for i, c in enumerate(names) for x in (F.lit(c), F.col(f"c_{i}"))]
    long = texts.select("grp", F.stack(F.lit(len(names)), *rows).alias("variable", "level")).filter("level IS NOT NULL")
    return long.groupBy("variable", "level", "grp").agg(F.count(F.lit(1)).alias("n"))


def only_groups(df: DataFrame, by: str, pairs: Pairs) -> DataFrame:
    """Rows of the groups that occur in a pair; all rows if no pairs are given."""
    if pairs is None:
        return df
    return df.filter(F.col(by).cast("string").isin(sorted({str(g) for pair in pairs for g in pair})))


def in_blocks(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` (keys, grp, ...) with the number of blocks of each key and the block of each group."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count_distinct("grp") / BLOCK_GROUPS).cast("int").alias("_blocks"))
    return rows.join(sizes, list(keys)).withColumn("_block", F.pmod(F.xxhash64("grp"), "_blocks").cast("int"))


def pair_up(rows: DataFrame, keys: Sequence[str], values: Sequence[str], pairs: Pairs) -> DataFrame:
    """(keys, group1, group2, and each value as value1 and value2) of two groups with the same keys.

    ``rows`` has one row for each key and group. All pairs come once, group1 before group2; or the given ones,
    in their own order.
    """
    keys = list(keys)
    if pairs is not None:
        given = rows.sparkSession.createDataFrame([(str(a), str(b)) for a, b in pairs], "group1 string, group2 string")

        def side(n):
            return rows.select(*keys, F.col("grp").alias(f"group{n}"), *[F.col(v).alias(f"{v}{n}") for v in values])

        return side(1).join(given, "group1").join(side(2), [*keys, "group2"]).select(
            *keys, "group1", "group2", *[f"{v}{n}" for v in values for n in (1, 2)]
        )
    blocked = rows if "_block" in rows.columns else in_blocks(rows, keys)
    own = F.struct("grp", *values)
    left = blocked.select(*keys, F.col("_block").alias("_i"), F.explode(F.sequence("_block", F.col("_blocks") - 1)).alias("_j"), own.alias("_a"))
    right = blocked.select(*keys, F.explode(F.sequence(F.lit(0), "_block")).alias("_i"), F.col("_block").alias("_j"), own.alias("_b"))
    met = left.join(right, [*keys, "_i", "_j"])
    a_first = F.col("_a.grp") < F.col("_b.grp")
    met = met.filter(a_first | ((F.col("_i") < F.col("_j")) & (F.col("_b.grp") < F.col("_a.grp"))))
    met = met.select(*keys, F.when(a_first, F.col("_a")).otherwise(F.col("_b")).alias("_1"), F.when(a_first, F.col("_b")).otherwise(F.col("_a")).alias("_2"))
    return met.select(
        *keys, F.col("_1.grp").alias("group1"), F.col("_2.grp").alias("group2"), *[F.col(f"_{n}.{v}").alias(f"{v}{n}") for v in values for n in (1, 2)]
    )


def group_totals(counts: DataFrame) -> DataFrame:
    """(variable, grp, t, levels): known values of each group, and how many different ones, from level counts."""
    return counts.groupBy("variable", "grp").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("levels"))


def level_pairs(counts: DataFrame, pairs: Pairs) -> DataFrame:
    """(variable, level, group1, group2, n1, n2, t1, t2): each level's rows in both groups, 0 where one lacks
    it, and the groups' rows with a known value."""
    totals = in_blocks(group_totals(counts).select("variable", "grp", "t"), ["variable"])
    # Every level meets every block of groups, a key of its own.
    sizes = totals.groupBy("variable").agg(F.max("_blocks").alias("_n"))
    levels = counts.select("variable", "level").distinct().join(sizes, "variable")
    levels = levels.select("variable", "level", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_block"))
    cells = levels.join(totals, ["variable", "_block"]).join(counts.select("variable", "level", "grp", "n"), ["variable", "level", "grp"], "left")
    cells = cells.withColumns({"n": F.coalesce("n", F.lit(0)).cast("double"), "t": F.col("t").cast("double")})
    return pair_up(cells, ["variable", "level"], ["n", "t"], pairs)
