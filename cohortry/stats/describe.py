"""Descriptions of columns: counts, missing values, quantiles, histograms, profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import few_valued, value_counts_long
from ..operators.joins import broadcast_if_small
from ..sources.tables import materialise
from .groups import number

ACCURACY = 100_000
# Parts into which the bracket of a quantile is cut.
BINS = 32


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def count_patients(df: DataFrame, key: str = "patid") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("patients"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def category_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(variable, level, missing, n) for each column; missing values are the level ``NA`` with ``missing`` true,
    which tells them from a text of that name."""
    counts = value_counts_long(df, names).withColumn("missing", F.col("level").isNull())
    return counts.select("variable", F.coalesce("level", F.lit("NA")).alias("level"), "missing", "n")


def _rows_from_columns(one_row: DataFrame, items: Sequence[Sequence[str]], names: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Turn columns of a summary into rows, one per item, the first entry of an item being a label."""
    rows = [x for label, *columns in items for x in (F.lit(label), *(F.col(f"`{c}`") for c in columns))]
    return one_row.select(*ids, F.stack(F.lit(len(items)), *rows).alias(*names))


def missing_percent(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(variable, missing, percent) for all columns in one pass."""
    names = list(names or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m_{i}") for i, c in enumerate(names)]
    )
    long = _rows_from_columns(wide, [(c, f"m_{i}") for i, c in enumerate(names)], ("variable", "missing"), ("_n",))
    return long.select("variable", "missing", (F.col("missing") * 100.0 / F.col("_n")).alias("percent"))


def _long_numbers(df: DataFrame, names: Sequence[str], by: str | None) -> DataFrame:
    numbers = [number(c).alias(c) for c in names]
    group = F.lit("") if by is None else F.col(by).cast("string")
    return df.select(group.alias("grp"), *numbers).unpivot("grp", list(names), "variable", "value").filter("value IS NOT NULL")


def exact_quantiles(
    df: DataFrame, names: Sequence[str], probs: Sequence[float], by: str | None = None, accuracy: int = ACCURACY
) -> DataFrame:
    """(grp, variable, prob, value), interpolated between neighbours; exact at any size.

    Three scans, the first two of them while the plan is built. A sketch brackets each quantile, with an
    error bound; the brackets, cut into ``BINS`` parts, and what lies between them are cells that divide the
    number line. The cells are counted, which tells the cell of each quantile, and only values in those
    cells are listed and ranked. No row is repeated for a quantile, and a sketch that misses costs time only.
    """
    slack = 3.0 / accuracy
    ends = [p for q in probs for p in (max(0.0, q - slack), min(1.0, q + slack))]
    if not names or not ends:
        return df.sparkSession.createDataFrame([], "grp string, variable string, prob double, value double")
    group = F.lit("") if by is None else F.col(by).cast("string")
    sketch = df.groupBy(group.alias("grp")).agg(*[F.percentile_approx(number(c), ends, accuracy).alias(f"q_{i}") for i, c in enumerate(names)])
    cuts = F.array(*[F.struct(F.lit(c).alias("variable"), F.sort_array(f"q_{i}").alias("cuts")) for i, c in enumerate(names)])
    bounds = materialise(sketch.select("grp", F.explode(cuts).alias("_b")).select("grp", "_b.*").filter("cuts IS NOT NULL"))

    at = [F.get("cuts", F.lit(i)) for i in range(len(ends))]
    part = reduce(lambda x, y: x + y, [(F.col("value") > c).cast("int") for c in at])
    low, high = F.get("cuts", F.col("part") - 1), F.get("cuts", F.col("part"))
    share = F.when((high - low > 0) & (high - low < float("inf")), (F.col("value") - low) / (high - low) * BINS)
    bin_ = F.coalesce(F.least(F.floor(share), F.lit(BINS - 1)).cast("int"), F.lit(0))
    cell = ["grp", "variable", "part", "bin"]
    rows = _long_numbers(df, names, by).join(broadcast_if_small(bounds), ["grp", "variable"])
    rows = rows.withColumn("part", part).withColumn("bin", bin_).select(*cell, "value")

    mine = Window.partitionBy("grp", "variable")
    counts = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).withColumn("total", F.sum("n").over(mine))
    counts = counts.withColumn("before", F.sum("n").over(mine.orderBy("part", "bin")) - F.col("n"))
    place = {q: (F.col("total") - 1) * float(q) for q in probs}
    ranks = F.array(*[
        F.struct(
            F.lit(float(q)).alias("prob"), (x - F.floor(x)).alias("rest"), F.lit(k).alias("k"),
            F.least(F.floor(x) + 1 + k, F.col("total")).cast("long").alias("rank"),
        )
        for q, x in place.items() for k in (0, 1)
    ])
    asked = counts.select(*cell, "before", "n", F.explode(ranks).alias("_r")).select(*cell, "before", "n", "_r.*")
    asked = materialise(asked.filter("before < rank AND rank <= before + n").drop("n"))

    listed = rows.join(broadcast_if_small(asked.select(*cell, "before").distinct()), cell).groupBy(*cell, "before", "value")
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*cell).orderBy("value"))
    ranked = listed.agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto).drop("before")
    hits = asked.join(ranked, cell).filter("upto - n < rank AND rank <= upto")
    both = hits.groupBy("grp", "variable", "prob", "rest").agg(
        F.max(F.when(F.col("k") == 0, F.col("value"))).alias("a"), F.max(F.when(F.col("k") == 1, F.col("value"))).alias("b")
    )
    return both.select("grp", "variable", "prob", (F.col("a") + (F.col("b") - F.col("a")) * F.col("rest")).alias("value"))


def box_summary(df: DataFrame, names: Sequence[str], by: str, accuracy: int = ACCURACY) -> DataFrame:
    """(variable, grp, low, q1, median, q3, high), the data of a box plot."""
    five = exact_quantiles(df, names, (0.0, 0.25, 0.5, 0.75, 1.0), by, accuracy)
    pick = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    return five.groupBy("variable", "grp").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(c) for c, p in pick.items()
    ])


def histogram(df: DataFrame, names: Sequence[str], bins: int = 30) -> DataFrame:
    """(variable, bin, low, high, n) for equal-width bins from the smallest to the largest value; empty bins have no row.

    Values that are not finite are counted apart, with bin, low and high null; missing values are left out.
    """
    names = list(names)
    apart = -1

    def finite(c):
        x = F.col(f"`{c}`").cast("double")
        return F.when(F.abs(x) < F.lit(float("inf")), x)

    if not names:
        return df.sparkSession.createDataFrame([], "variable string, bin int, low double, high double, n bigint")
    ends = df.agg(*[F.struct(F.min(finite(c)), F.max(finite(c))).alias(f"e_{i}") for i, c in enumerate(names)]).first()
    out = []
    for i, c in enumerate(names):
        low, high = ends[f"e_{i}"]
        if low is None:
            low = high = 0.0
        width = (high - low) / bins or 1.0
        value = finite(c)
        # least() passes over nulls, so a missing value needs its own branch.
        spot = F.when(value.isNotNull(), F.least(F.floor((value - low) / width), F.lit(bins - 1)))
        out.append((c, low, width, spot.when(F.col(f"`{c}`").isNotNull(), F.lit(apart)).cast("int")))
    wide = df.select(*[spot.alias(c) for c, _, _, spot in out])
    counts = wide.unpivot([], [c for c, *_ in out], "variable", "bin").filter("bin IS NOT NULL")
    counts = counts.groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("bin", F.nullif("bin", F.lit(apart)))
    low, width = F.lit(None).cast("double"), F.lit(None).cast("double")
    for c, start, step, _ in out:
        low = F.when(F.col("variable") == c, F.lit(start)).otherwise(low)
        width = F.when(F.col("variable") == c, F.lit(step)).otherwise(width)
    return counts.select(
        "variable", "bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"), "n"
    )


def profile_columns(
    df: DataFrame, names: Sequence[str] | None = None, few: int = 20, rare: int = 6, accuracy: int = ACCURACY
) -> DataFrame:
    """One row per column: type, missing, distinct values, mode, range, quartiles, rare levels, outliers.

    A column with fewer than ``few`` distinct values is a factor: its levels seen fewer than ``rare``
    times are listed. Other numeric columns get quartiles and the number of values, and of
    distinct values, more than 1.5 quartile ranges outside the quartiles.
    """
    names = list(names or df.columns)
    kinds = {c: df.schema[c].dataType for c in names}
    factors = few_valued(df, names, few)
    numeric = [c for c in names if isinstance(kinds[c], T.NumericType) and c not in factors]
    counts = value_counts_long(df, names)
    seen = F.col("level").isNotNull()
    is_factor = F.col("variable").isin(factors) if factors else F.lit(False)
    base = counts.groupBy("variable").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(~seen, F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(seen).alias("distinct_values"),
        F.max(F.when(seen, F.struct(F.col("n"), F.col("level")))).alias("_mode"),
        F.array_join(F.array_sort(F.collect_list(F.when(is_factor & seen & (F.col("n") < rare), F.col("level")))), ",").alias("rare_levels"),
    )
    kind = F.lit(None).cast("string")
    for c in names:
        label = "factor" if c in factors else kinds[c].simpleString()
        kind = F.when(F.col("variable") == c, F.lit(label)).otherwise(kind)
    out = base.select(
        "variable", kind.alias("kind"), "rows", "missing", (F.col("missing") * 100.0 / F.col("rows")).alias("missing_percent"),
        "distinct_values", F.col("_mode.level").alias("mode"), F.col("_mode.n").alias("mode_count"), "rare_levels",
    )
    if not numeric:
        return out
    labels = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    quantiles = exact_quantiles(df, numeric, tuple(labels.values()), accuracy=accuracy)
    five = quantiles.groupBy("variable").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(c) for c, p in labels.items()])
    # One row per numeric column: few enough to collect, and to broadcast below.
    found = five.collect()
    outside = F.lit(False)
    for row in found:
        reach = (row.q3 - row.q1) * 1.5
        beyond = ~F.col("value").between(row.q1 - reach, row.q3 + reach)
        outside = F.when(F.col("variable") == row.variable, beyond).otherwise(outside)
    extremes = _long_numbers(df, numeric, None).filter(outside).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    outliers = extremes.groupBy("variable").agg(F.sum("n").alias("outliers"), F.count(F.lit(1)).alias("outlier_values"))
    spread = df.sparkSession.createDataFrame(found, five.schema)
    return out.join(F.broadcast(spread), "variable", "left").join(F.broadcast(outliers), "variable", "left").fillna(
        0, subset=["outliers", "outlier_values"]
    )
