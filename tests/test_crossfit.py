"""The cross-fitted effect: weights, folds, coverage and learners."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.stats import crossfit
from cohortry.stats.crossfit import convex_weights, learner_weights, tmle_crossfit


def patients(spark, n, seed, effect=0.8):
    """A number and a factor act on treatment and outcome; outcomes also bend with the square of the number."""
    rnd = np.random.default_rng(seed)
    w1, w2 = rnd.normal(size=n).round(3), rnd.integers(0, 3, n)
    expit = lambda x: 1 / (1 + np.exp(-x))
    a = rnd.random(n) < expit(0.5 * (w2 == 1) - 0.6 * (w2 == 2) + 0.4 * w1)
    p1, p0 = (expit(-1 + effect * t + 0.9 * (w2 == 2) + 0.5 * w1 + 0.3 * w1**2) for t in (1, 0))
    y = rnd.random(n) < np.where(a, p1, p0)
    rows = [(i, int(v), int(t), float(x), str(k)) for i, (v, t, x, k) in enumerate(zip(y, a, w1, w2))]
    return spark.createDataFrame(rows, "id long, y int, a int, w1 double, w2 string"), p1.mean(), p0.mean()


def estimates(df, **options):
    return {r.estimand: r for r in tmle_crossfit(df, "y", "a", "id", **options).collect()}


def same(left, right):
    """Equal but for the order in which sums were taken."""
    assert set(left) == set(right)
    for name, r in left.items():
        assert tuple(r)[1:] == pytest.approx(tuple(right[name])[1:], abs=1e-9)


@pytest.mark.parametrize("seed", range(6))
def test_weights_are_the_least_on_a_grid(seed):
    rnd = np.random.default_rng(seed)
    z = rnd.random((50, 3))
    y = rnd.random(50) if seed % 2 else z[:, 0] * 0.3 + z[:, 1] * 0.7
    gram, cross = z.T @ z / 50, z.T @ y / 50
    w = convex_weights(gram, cross)
    assert w.min() >= 0 and w.sum() == pytest.approx(1)

    def error(v):
        return v @ gram @ v - 2 * cross @ v

    grid = [np.array([i, j, 100 - i - j]) / 100 for i, j in itertools.product(range(101), repeat=2) if i + j <= 100]
    assert error(w) <= min(map(error, grid)) + 1e-12


def test_weights_of_equal_learners():
    assert convex_weights(np.ones((2, 2)), np.ones(2)).sum() == pytest.approx(1)


def test_all_learners_find_a_known_effect(spark):
    df, p1, p0 = patients(spark, 6000, 1)
    found, weights = crossfit.crossfit(df, "y", "a", "id", covariates=["w1"], categorical=["w2"], folds=3)
    rows = {r.estimand: r for r in found.collect()}
    truth = {"risk difference": p1 - p0, "relative risk": p1 / p0, "odds ratio": p1 * (1 - p0) / (p0 * (1 - p1))}
    for name, r in rows.items():
        scale = 1 if name == "risk difference" else truth[name]
        assert abs(r.estimate - truth[name]) < 3.5 * r.std_error * scale and r.ci_low < r.estimate < r.ci_high and r.n == 6000
    assert 0.008 < rows["risk difference"].std_error < 0.02
    for target in ("outcome", "treatment"):
        of = {r.learner: r for r in weights.collect() if r.target == target}
        assert list(of) == ["mean", "cells", "logistic", "trees"] and sum(r.weight for r in of.values()) == pytest.approx(1)
        assert min(r.weight for r in of.values()) >= 0 and of["logistic"].loss < of["mean"].loss


def test_limits_cover_the_truth(spark):
    """Twenty samples: limits of 95 % miss the truth in at most four (a chance of 0.3 % for more)."""
    missed = 0
    for seed in range(20):
        df, p1, p0 = patients(spark, 1200, 100 + seed)
        cut = df.withColumn("w3", F.floor(F.col("w1") * 2).cast("string"))
        r = estimates(cut, categorical=["w2", "w3"], learners=("mean", "cells"))["risk difference"]
        missed += not r.ci_low <= p1 - p0 <= r.ci_high
    assert missed <= 4


def test_repeated_rows_count_as_often_as_they_stand_there(spark):
    df, *_ = patients(spark, 800, 3)
    df = df.drop("w1")
    twice = estimates(df.union(df), categorical=["w2"], learners=("cells", "logistic"))
    again = estimates(df.union(df).repartition(7), categorical=["w2"], learners=("logistic", "cells"))
    once = estimates(df, categorical=["w2"], learners=("cells", "logistic"))
    for name, r in twice.items():
        assert r.n == 1600 and r.estimate == pytest.approx(again[name].estimate, abs=1e-7)
        assert r.std_error == pytest.approx(once[name].std_error / 2**0.5, rel=0.02)


def test_folds_hold_whole_keys(spark):
    df = spark.range(2000).withColumn("k", F.col("id") % 100).union(spark.createDataFrame([(1, None)] * 3, "id long, k long"))
    folds = df.select("k", crossfit.fold_of("k", 7).alias("fold")).distinct().collect()
    assert len(folds) == 101 and {r.fold for r in folds} == set(range(7))


def test_incomplete_rows_named_treatments_and_no_covariates(spark):
    df, *_ = patients(spark, 900, 5)
    holes = df.union(df.limit(50).withColumn("w2", F.lit(None).cast("string")))
    shares = {"categorical": ["w2"], "learners": ("mean", "cells")}
    same(estimates(holes, **shares), estimates(df, **shares))
    named = df.withColumn("a", F.when(F.col("a") == 1, "new").otherwise("old")).union(df.limit(9).withColumn("a", F.lit("third")))
    same(estimates(named, treatments=("old", "new"), **shares), estimates(df, **shares))
    bare = {r.learner: r.weight for r in learner_weights(df, "y", "a", "id").collect()}
    assert bare == {"mean": 1.0}
    # Without covariates the estimate is the plain difference of the arms, but for the folds' own shares.
    plain = df.agg((F.avg(F.when(F.col("a") == 1, F.col("y"))) - F.avg(F.when(F.col("a") == 0, F.col("y")))).alias("d")).first().d
    found = estimates(df)["risk difference"]
    assert abs(found.estimate - plain) < 0.1 * found.std_error


def test_errors(spark):
    df, *_ = patients(spark, 100, 6)
    for wrong, message in (
        (df.limit(0), "no complete rows"), (df.withColumn("a", F.lit(1)), "one value"), (df.withColumn("y", F.lit(0)), "one value"),
    ):
        with pytest.raises(ValueError, match=message):
            estimates(wrong, categorical=["w2"], learners=("cells", "mean"))
    for options, message in (({"learners": ("boost",)}, "boost"), ({"folds": 1}, "two or more"), ({"learners": ("cells",)}, "no learner")):
        with pytest.raises(ValueError, match=message):
            estimates(df, **options)
    with pytest.raises(Exception, match="must be 0 or 1"):
        estimates(df.withColumn("y", F.col("y") + 1))
