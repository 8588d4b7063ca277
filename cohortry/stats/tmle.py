"""Targeted maximum likelihood estimate of a binary treatment's effect on a binary outcome."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "estimand string, estimate double, std_error double, ci_low double, ci_high double, n bigint"


def _logistic(label: str, features: str, **options) -> GeneralizedLinearRegression:
    return GeneralizedLinearRegression(
        family="binomial", link="logit", labelCol=label, featuresCol=features, maxIter=50, tol=1e-10, **options
    )


def _binary(name: str) -> Column:
    x = F.col(name).cast("double")
    wrong = F.raise_error(F.lit(f"{name} must be 0 or 1")).cast("double")
    return F.when(x.isNull() | x.isin(0.0, 1.0), x).otherwise(wrong)


def _with_covariates(df: DataFrame, covariates: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    inputs = list(covariates)
    if categorical:
        texts = df.withColumns({c: F.col(c).cast("string") for c in categorical})
        index = StringIndexer(inputCols=list(categorical), outputCols=[f"_ix_{c}" for c in categorical], stringOrderType="alphabetAsc")
        dummy = OneHotEncoder(inputCols=[f"_ix_{c}" for c in categorical], outputCols=[f"_oh_{c}" for c in categorical], dropLast=True)
        indexed = index.fit(texts).transform(texts)
        df = dummy.fit(indexed).transform(indexed)
        inputs += [f"_oh_{c}" for c in categorical]
    return VectorAssembler(inputCols=inputs, outputCol="_w").transform(df)


def tmle_binary(
    df: DataFrame, outcome: str, treatment: str, covariates: Sequence[str] = (), categorical: Sequence[str] = (),
    clip: float = 0.025, treatments: tuple | None = None,
) -> DataFrame:
    """Risk difference, relative risk and odds ratio with standard errors and 95 % limits.

    Logistic models give the outcome under each treatment and the chance of treatment, which is kept
    within [clip, 1 - clip]. A second logistic model, without intercept and with the first prediction as
    offset, moves the predictions along the two inverse-probability covariates. Variances come from the
    influence curve; those of ratios are on the log scale. Only model coefficients and one summary row
    reach the driver. ``treatments`` (without, with) picks two of several treatments; otherwise the
    treatment is 0 or 1, as the outcome always is, and anything else is an error. Only complete rows are
    used, and ``n`` counts them; an outcome or treatment that is the same in all of them is an error.
    """
    treated = _binary(treatment)
    if treatments is not None:
        value = F.col(treatment).cast("string")
        treated = F.when(value == str(treatments[1]), 1.0).when(value == str(treatments[0]), 0.0)
    rows = df.select(_binary(outcome).alias("_y"), treated.alias("_a"), *covariates, *categorical).dropna()
    rows = _with_covariates(rows, covariates, categorical).select("_y", "_a", "_w")
    rows = VectorAssembler(inputCols=["_a", "_w"], outputCol="_aw").transform(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seen = rows.agg(F.min("_y") == F.max("_y"), F.min("_a") == F.max("_a")).first()
        for name, same in zip((outcome, treatment), seen):
            if same is not False:
                raise ValueError(f"{name} has one value, or there are no complete rows")
        outcome_model = _logistic("_y", "_aw").fit(rows)
        chance_model = _logistic("_a", "_w", predictionCol="_g").fit(rows)
        step = float(outcome_model.coefficients[0])
        untreated = VectorAssembler(inputCols=["_zero", "_w"], outputCol="_aw0").transform(
            chance_model.transform(rows).withColumn("_zero", F.lit(0.0))
        )
        first = outcome_model.setFeaturesCol("_aw0").setPredictionCol("_q0").setLinkPredictionCol("_l0").transform(untreated)
        g = F.least(F.greatest("_g", F.lit(clip)), F.lit(1 - clip))
        first = first.select(
            "_y", "_a", "_l0", (F.col("_l0") + step).alias("_l1"), (F.col("_l0") + F.col("_a") * step).alias("_la"), g.alias("_g")
        ).withColumns({"_h1": F.col("_a") / F.col("_g"), "_h0": (1 - F.col("_a")) / (1 - F.col("_g"))})
        first = VectorAssembler(inputCols=["_h1", "_h0"], outputCol="_h").transform(first)
        moved = _logistic("_y", "_h", fitIntercept=False, offsetCol="_la").fit(first)
        e1, e0 = (float(v) for v in moved.coefficients)

        def chance(logit):
            return 1 / (1 + F.exp(-logit))

        q1, q0 = chance(F.col("_l1") + e1 / F.col("_g")), chance(F.col("_l0") + e0 / (1 - F.col("_g")))
        final = first.withColumns({"_q1": q1, "_q0": q0}).withColumns({
            "_u1": F.col("_h1") * (F.col("_y") - F.col("_q1")) + F.col("_q1"),
            "_u0": F.col("_h0") * (F.col("_y") - F.col("_q0")) + F.col("_q0"),
        })
        s = final.agg(
            F.count(F.lit(1)).alias("n"), F.avg("_q1").alias("p1"), F.avg("_q0").alias("p0"),
            F.var_samp("_u1").alias("v1"), F.var_samp("_u0").alias("v0"), F.covar_samp("_u1", "_u0").alias("v10"),
        )
        return _estimates(s)
    finally:
        rows.unpersist()


def _estimates(summary: DataFrame) -> DataFrame:
    s = summary.first()

    def error(w1, w0):
        return math.sqrt(max(0.0, w1 * w1 * s.v1 + w0 * w0 * s.v0 - 2 * w1 * w0 * s.v10) / s.n)

    p1, p0, z = s.p1, s.p0, 1.959963984540054
    out = [("risk difference", p1 - p0, error(1, 1), False)]
    if 0 < p1 < 1 and 0 < p0 < 1:
        out.append(("relative risk", p1 / p0, error(1 / p1, 1 / p0), True))
        out.append(("odds ratio", p1 * (1 - p0) / (p0 * (1 - p1)), error(1 / (p1 * (1 - p1)), 1 / (p0 * (1 - p0))), True))
    rows = [
        (name, est, se, est * math.exp(-z * se) if ratio else est - z * se, est * math.exp(z * se) if ratio else est + z * se, s.n)
        for name, est, se, ratio in out
    ]
    return summary.sparkSession.createDataFrame(rows, RESULT)
