"""Cross-fitted targeted maximum likelihood estimate with stacked learners."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .tmle import _binary, _estimates, _logistic, _with_covariates

WEIGHTS = "target string, learner string, weight double, loss double"
LEARNERS = ("mean", "cells", "logistic", "trees")
# A cell counts as one more row with the mean of its arm, so that rare cells have a chance too.
SHRINK = 1.0
BOUND = 0.001


def fold_of(key: str, folds: int) -> Column:
    """A fold from 0 on, the same for all rows of a key; rows without a key are in one fold."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") % folds).cast("int")


def convex_weights(gram: np.ndarray, cross: np.ndarray) -> np.ndarray:
    """Weights of least squared error that are not negative and sum to one.

    Each set of learners is solved with the sum fixed; of the solutions without a negative weight the one
    of least error is the answer. Exact, and cheap for the few learners there are.
    """
    k, best, least = len(cross), None, np.inf
    for size in range(1, k + 1):
        for chosen in map(list, combinations(range(k), size)):
            system = np.ones((size + 1, size + 1))
            system[:size, :size], system[size, size] = gram[np.ix_(chosen, chosen)], 0
            part = np.linalg.lstsq(system, np.append(cross[chosen], 1.0), rcond=1e-13)[0][:size]
            if part.min() < 0 or abs(part.sum() - 1) > 1e-9:
                continue
            w = np.zeros(k)
            w[chosen] = part
            error = w @ gram @ w - 2 * cross @ w
            if error < least - 1e-12 * abs(least if best is not None else 1):
                best, least = w, error
    return best


def _sums(rows: DataFrame, *by: str) -> DataFrame:
    """Rows and outcomes of either arm."""
    n, y, a = F.col("_n").cast("double"), F.col("_y"), F.col("_a")
    return rows.groupBy(*by).agg(
        F.sum(n * a).alias("_n1"), F.sum(n * a * y).alias("_s1"), F.sum(n * (1 - a)).alias("_n0"), F.sum(n * (1 - a) * y).alias("_s0")
    )


def _fold_means(rows: DataFrame, folds: int) -> DataFrame:
    """For each fold the means of all other folds, a row a fold. It is an error if they lack an arm or an outcome."""
    names = ("_n1", "_s1", "_n0", "_s0")
    seen = {r["_fold"]: np.array([r[n] for n in names]) for r in _sums(rows, "_fold").collect()}
    total = sum(seen.values(), np.zeros(4))
    out = []
    for fold in sorted(seen):
        n1, s1, n0, s0 = (float(v) for v in total - seen[fold])
        if n1 == 0 or n0 == 0 or s1 + s0 == 0 or s1 + s0 == n1 + n0:
            raise ValueError(f"without fold {fold} of {folds} the treatment or the outcome has one value")
        out.append((fold, s1 / n1, s0 / n0, n1 / (n1 + n0)))
    if not out:
        raise ValueError("there are no complete rows")
    return rows.sparkSession.createDataFrame(out, "_fold int, _q1_mean double, _q0_mean double, _g_mean double")


def _add_cells(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Shares of a cell's rows in all other folds: the cell's sums less those of the fold, from one aggregate."""
    cell = Window.partitionBy(*by)
    per = _sums(rows, "_fold", *by)
    per = per.select("_fold", *by, *[(F.sum(n).over(cell) - F.col(n)).alias(f"_o{n}") for n in ("_n1", "_s1", "_n0", "_s0")])

    def share(hits, n, prior):
        return (hits + SHRINK * F.col(prior)) / (n + SHRINK)

    n1, s1, n0, s0 = (F.col(f"_o{n}") for n in ("_n1", "_s1", "_n0", "_s0"))
    return rows.join(per, ["_fold", *by]).withColumns({
        "_q1_cells": share(s1, n1, "_q1_mean"), "_q0_cells": share(s0, n0, "_q0_mean"), "_g_cells": share(n1, n1 + n0, "_g_mean"),
    }).drop("_o_n1", "_o_s1", "_o_n0", "_o_s0")


def _logistic_part(train: DataFrame, held: DataFrame) -> DataFrame:
    options = {"weightCol": "_n", "regParam": 1e-6}
    outcome, chance = _logistic("_y", "_x", **options).fit(train), _logistic("_a", "_w", **options).fit(train)
    for arm in (1, 0):
        held = outcome.setFeaturesCol(f"_x{arm}").setPredictionCol(f"_q{arm}_logistic").transform(held)
    return chance.setPredictionCol("_g_logistic").transform(held)


def _trees_part(train: DataFrame, held: DataFrame) -> DataFrame:
    # Without bootstrapping a weighted row is the same as its repetitions.
    options = {"weightCol": "_n", "numTrees": 20, "maxDepth": 5, "bootstrap": False, "featureSubsetStrategy": "0.6", "seed": 7}
    outcome = RandomForestClassifier(labelCol="_y", featuresCol="_x", **options).fit(train)
    chance = RandomForestClassifier(labelCol="_a", featuresCol="_w", **options).fit(train)
    for model, features, name in ((outcome, "_x1", "_q1_trees"), (outcome, "_x0", "_q0_trees"), (chance, "_w", "_g_trees")):
        model = model.setFeaturesCol(features).setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("")
        held = model.transform(held).withColumn(name, vector_to_array("_p")[1]).drop("_p")
    return held


_FITTED: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {"logistic": _logistic_part, "trees": _trees_part}


def _add_fitted(rows: DataFrame, folds: int, part: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """A model a fold, fitted on the others; stored, so that the next learner starts from a table."""
    fold = F.col("_fold")
    return materialise(reduce(DataFrame.unionByName, (part(rows.filter(fold != v), rows.filter(fold == v)) for v in range(folds))))


def _stack(rows: DataFrame, learners: Sequence[str], label: str, guesses: Sequence[Column]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the learners and the mean squared error of each, from one aggregate of their products."""
    n, y, k = F.col("_n"), F.col(label), len(learners)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    s = rows.agg(
        F.sum(n), F.sum(n * y * y), *[F.sum(n * g * y) for g in guesses], *[F.sum(n * guesses[i] * guesses[j]) for i, j in pairs]
    ).first()
    total, square, cross = float(s[0]), float(s[1]) / s[0], np.array(s[2 : 2 + k], float) / s[0]
    gram = np.zeros((k, k))
    for (i, j), v in zip(pairs, s[2 + k :]):
        gram[i, j] = gram[j, i] = v / total
    return convex_weights(gram, cross), square - 2 * cross + np.diag(gram)


def crossfit(
    df: DataFrame, outcome: str, treatment: str, key: str, covariates: Sequence[str] = (), categorical: Sequence[str] = (),
    folds: int = 5, learners: Sequence[str] = LEARNERS, clip: float = 0.025, treatments: tuple | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Risk difference, relative risk and odds ratio, and the learners' weights behind them.

    Rows are dealt into ``folds`` by a hash of ``key``, so that all rows of a patient are in one. Each learner
    gives every row the outcome under either treatment and the chance of treatment from models of the other
    folds alone: ``mean`` the share in the arm, ``cells`` the share among rows with the same categorical
    covariates (drawn to the arm's share by one row), ``logistic`` a main-terms model, ``trees`` a forest.
    For outcome and treatment apart, non-negative weights that sum to one and give the least squared error
    combine the learners. One step of targeting on all rows moves the combined outcomes, which are kept
    within [0.001, 0.999], and variances come from the influence curve, in which no row meets a model it was
    used for. Rows count as independent, also those of one key.

    Equal rows of a fold are reduced to one with its number first, so that with categorical covariates alone
    the models see a row for each pattern, however many patients there are. Learners without a covariate of their kind
    (``cells`` without a categorical one, ``logistic`` and ``trees`` without any) are left out. Only complete
    rows are used; a null key is a key of its own. An empty table, or folds that leave a single treatment or
    outcome, are an error. Only coefficients and summary rows reach the driver.
    """
    unknown = set(learners) - set(LEARNERS)
    if unknown or not learners or folds < 2:
        raise ValueError(f"learners are some of {LEARNERS} and folds two or more: {sorted(unknown)}, {folds}")
    inputs = [*covariates, *categorical]
    learners = [m for m in LEARNERS if m in learners and (m == "mean" or (categorical if m == "cells" else inputs))]
    if not learners:
        raise ValueError("no learner has a covariate")
    treated = _binary(treatment)
    if treatments is not None:
        value = F.col(treatment).cast("string")
        treated = F.when(value == str(treatments[1]), 1.0).when(value == str(treatments[0]), 0.0)
    rows = df.select(_binary(outcome).alias("_y"), treated.alias("_a"), fold_of(key, folds).alias("_fold"), *inputs).dropna()
    rows = materialise(rows.groupBy("_fold", "_y", "_a", *inputs).agg(F.count(F.lit(1)).alias("_n")))
    # A row a fold, whatever the data.
    rows = rows.join(F.broadcast(_fold_means(rows, folds)), "_fold")
    if "cells" in learners:
        rows = _add_cells(rows, categorical)
    fitted = [m for m in learners if m in _FITTED]
    if fitted:
        rows = _with_covariates(rows, covariates, categorical).withColumns({"_one": F.lit(1.0), "_zero": F.lit(0.0)})
        for first, name in (("_a", "_x"), ("_one", "_x1"), ("_zero", "_x0")):
            rows = VectorAssembler(inputCols=[first, "_w"], outputCol=name).transform(rows)
    rows = materialise(rows)
    for m in fitted:
        rows = _add_fitted(rows, folds, _FITTED[m])

    a = F.col("_a")
    q_weights, q_loss = _stack(rows, learners, "_y", [F.when(a == 1, F.col(f"_q1_{m}")).otherwise(F.col(f"_q0_{m}")) for m in learners])
    g_weights, g_loss = _stack(rows, learners, "_a", [F.col(f"_g_{m}") for m in learners])

    def combined(prefix, weights):
        return sum((float(w) * F.col(f"{prefix}_{m}") for w, m in zip(weights, learners)), F.lit(0.0))

    def within(x, low):
        return F.least(F.greatest(x, F.lit(low)), F.lit(1 - low))

    def logit(p):
        return F.log(p / (1 - p))

    rows = rows.select(
        "_y", "_a", "_n", logit(within(combined("_q1", q_weights), BOUND)).alias("_l1"),
        logit(within(combined("_q0", q_weights), BOUND)).alias("_l0"), within(combined("_g", g_weights), clip).alias("_g"),
    ).withColumns({"_la": F.when(a == 1, F.col("_l1")).otherwise(F.col("_l0")), "_h1": a / F.col("_g"), "_h0": (1 - a) / (1 - F.col("_g"))})
    rows = materialise(VectorAssembler(inputCols=["_h1", "_h0"], outputCol="_h").transform(rows))
    moved = _logistic("_y", "_h", fitIntercept=False, offsetCol="_la", weightCol="_n").fit(rows)
    e1, e0 = (float(v) for v in moved.coefficients)
    summary = _weighted_summary(rows, e1, e0)
    weights = [
        (target, m, float(w), float(e))
        for target, ws, loss in (("outcome", q_weights, q_loss), ("treatment", g_weights, g_loss)) for m, w, e in zip(learners, ws, loss)
    ]
    return _estimates(summary), df.sparkSession.createDataFrame(weights, WEIGHTS)


def _weighted_summary(rows: DataFrame, e1: float, e0: float) -> DataFrame:
    """Targeted means and the variances of the influence curve, rows counted as often as they stand for."""

    def chance(x):
        return 1 / (1 + F.exp(-x))

    n, y, q1, q0, u1, u0 = (F.col(c) for c in ("_n", "_y", "_q1", "_q0", "_u1", "_u0"))
    moved = rows.withColumns({"_q1": chance(F.col("_l1") + e1 / F.col("_g")), "_q0": chance(F.col("_l0") + e0 / (1 - F.col("_g")))})
    moved = moved.withColumns({"_u1": F.col("_h1") * (y - q1) + q1, "_u0": F.col("_h0") * (y - q0) + q0})
    s = moved.agg(
        F.sum(n).alias("n"), (F.sum(n * q1) / F.sum(n)).alias("p1"), (F.sum(n * q0) / F.sum(n)).alias("p0"),
        F.sum(n * u1).alias("s1"), F.sum(n * u0).alias("s0"),
        F.sum(n * u1 * u1).alias("s11"), F.sum(n * u0 * u0).alias("s00"), F.sum(n * u1 * u0).alias("s10"),
    )

    def moment(product, left, right):
        return F.expr(f"({product} - {left} * {right} / n) / (n - 1)")

    return s.select(
        "n", "p1", "p0", moment("s11", "s1", "s1").alias("v1"), moment("s00", "s0", "s0").alias("v0"), moment("s10", "s1", "s0").alias("v10")
    )


def tmle_crossfit(df: DataFrame, outcome: str, treatment: str, key: str, **options) -> DataFrame:
    """The estimates of ``crossfit``, whose options it takes."""
    return crossfit(df, outcome, treatment, key, **options)[0]


def learner_weights(df: DataFrame, outcome: str, treatment: str, key: str, **options) -> DataFrame:
    """The weight of each learner and its mean squared error on rows it was not fitted to."""
    return crossfit(df, outcome, treatment, key, **options)[1]
