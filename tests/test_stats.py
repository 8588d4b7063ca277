import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.functions.tails import chi2_p
from cohortry.stats import association, balance, describe, groups, tmle


def from_counts(spark, rows, schema):
    """Rows repeated as often as their last field says."""
    names = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame(rows, schema + ", n int")
    return df.withColumn("i", F.explode(F.sequence(F.lit(1), "n"))).select(*names)


# Published counts and the published results for them.
SEX_BY_OUTCOME = [("1", "1", 1026), ("2", "1", 1081), ("1", "2", 132), ("2", "2", 93)]
SEX_BY_TREATMENT = [(1, "1", 159950 - 72377), (2, "1", 72377), (1, "2", 483118 - 205425), (2, "2", 205425)]
ETHNIC = {"1": (9633, 3765, 964, 140081, 207, 5300), "2": (36467, 14974, 3512, 417135, 984, 10046)}
CHI_SQUARE_P = [(24.5350, 4, 6.2385e-05), (10.5685, 5, 0.060640), (35.8842, 5, 1.0018e-06)]


def test_chi_square_published(spark):
    df = from_counts(spark, SEX_BY_OUTCOME, "sex string, outcome string")
    r = association.chi_square_pairs(df, "outcome", ["sex"], [(1, 2)]).first()
    assert r.statistic == pytest.approx(8.086294195618958, rel=1e-12) and r.dof == 1
    assert r.p_value == pytest.approx(0.004460126874243242, rel=1e-10)


@pytest.mark.parametrize("statistic, dof, p", CHI_SQUARE_P)
def test_chi_square_tail_published(spark, statistic, dof, p):
    df = spark.createDataFrame([(statistic, dof)], "s double, d int")
    assert df.select(chi2_p("s", "d").alias("p")).first().p == pytest.approx(p, rel=2e-4)


def test_numeric_smd_published(spark):
    df = from_counts(spark, SEX_BY_TREATMENT, "sex int, treatment string")
    r = balance.smd_numeric(df, "treatment", ["sex"], [(1, 2)]).first()
    assert r.smd == pytest.approx(0.05501544881322781, rel=1e-10)
    signed = balance.smd_pairs(df, "treatment", ["sex"], [], [(1, 2)]).first()
    assert signed.smd == pytest.approx(-0.05501544881322781, rel=1e-10)


def test_multilevel_smd_published(spark):
    rows = [(str(i), g, n) for g, counts in ETHNIC.items() for i, n in enumerate(counts)]
    df = from_counts(spark, rows, "ethnic string, treatment string")
    got = balance.smd_multilevel(df, "treatment", ["ethnic"], [(1, 2)]).first().smd
    p, q = (np.array(ETHNIC[g]) / sum(ETHNIC[g]) for g in "12")
    cov = lambda v: np.diag(v) - np.outer(v, v)
    s, d = ((cov(p) + cov(q)) / 2)[1:, 1:], (q - p)[1:]
    assert got == pytest.approx(math.sqrt(d @ np.linalg.solve(s, d)), rel=1e-9)
    assert round(got, 3) == 0.109


def test_missing_share_published(spark):
    df = spark.range(826350).select(F.when(F.col("id") >= 175531, F.lit(1)).alias("bmi"))
    r = describe.missing_percent(df).first()
    assert r.missing == 175531 and round(r.percent, 2) == 21.24


def test_smd_edges(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 1.0, "x"), ("b", 1.0, "x"), ("b", 1.0, "y"), (None, 9.0, "z")], "g string, v double, k string")
    assert balance.smd_numeric(df, "g", ["v"]).first().smd is None
    assert balance.smd_multilevel(df, "g", ["k"]).first().smd is None
    rows = {r.level: r.smd for r in balance.smd_categorical(df, "g", ["k"]).collect()}
    assert rows == {"x": pytest.approx(0.5 / math.sqrt(0.125)), "y": pytest.approx(0.5 / math.sqrt(0.125))}


def test_two_levels_have_the_binary_distance(spark):
    df = from_counts(spark, [("0", "a", 70), ("1", "a", 30), ("0", "b", 45), ("1", "b", 55)], "k string, g string")
    one = balance.smd_multilevel(df, "g", ["k"]).first().smd
    assert one == pytest.approx(balance.smd_binary(df, "g", ["k"]).first().smd)


def test_chi_square_counts_empty_cells(spark):
    df = from_counts(spark, [("x", "a", 10), ("y", "a", 5), ("x", "b", 7), ("z", "b", 3)], "k string, g string")
    got = association.chi_square(groups.level_counts(df, ["k"], "g"), ["variable"]).first()
    table = np.array([[10, 7], [5, 0], [0, 3]], float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert got.statistic == pytest.approx(((table - expected) ** 2 / expected).sum()) and (got.dof, got.n) == (2, 25)


def test_stratum_against_rest(spark):
    df = from_counts(spark, [("x", "a", 10), ("y", "a", 5), ("x", "b", 7), ("z", "b", 3), ("x", "c", 50)], "k string, g string")
    rows = {(r.stratum, r.group1, r.group2): r.statistic for r in association.chi_square_by_stratum(df, "k", "g", [("a", "b")]).collect()}
    table = np.array([[10, 7], [5, 3]], float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert rows[("x", "a", "b")] == pytest.approx(((table - expected) ** 2 / expected).sum())
    assert set(rows) == {("x", "a", "b"), ("y", "a", "b"), ("z", "a", "b")}


def test_welch_and_anova(spark):
    rnd = random.Random(5)
    data = {g: [rnd.gauss(m, s) for _ in range(n)] for g, m, s, n in (("a", 0, 1, 12), ("b", 1, 3, 20), ("c", 0.5, 2, 7))}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs] + [("a", None)], "g string, v double")
    rows = {(r.group1, r.group2): r for r in association.welch_t_pairs(df, "g", ["v"]).collect()}
    assert set(rows) == {("a", "b"), ("a", "c"), ("b", "c")}
    a, b = data["a"], data["b"]
    se = statistics.variance(a) / 12 + statistics.variance(b) / 20
    assert rows[("a", "b")].statistic == pytest.approx((statistics.mean(a) - statistics.mean(b)) / math.sqrt(se))
    f = association.anova(groups.moments(df, ["v"], "g")).first()
    grand = statistics.mean(v for vs in data.values() for v in vs)
    between = sum(len(v) * (statistics.mean(v) - grand) ** 2 for v in data.values()) / 2
    within = sum((len(v) - 1) * statistics.variance(v) for v in data.values()) / 36
    assert f.statistic == pytest.approx(between / within) and (f.dof1, f.dof2) == (2, 36)


def test_anova_of_two_groups_is_the_squared_t(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 4, 7)] + [("b", float(v)) for v in (3, 5, 5, 9)], "g string, v double")
    t = association.welch_t_pairs(df, "g", ["v"]).first()
    tests = balance.table_one_tests(df.withColumn("k", F.lit("x")), "g", ["k"], ["v"]).filter("variable = 'v'").first()
    assert tests.statistic == pytest.approx(t.statistic ** 2)


def test_number_of_groups_is_not_limited(spark):
    many = spark.range(120).selectExpr("id", "id % 60 AS g")
    assert balance.smd_numeric(many, "g", ["id"]).count() == 60 * 59 // 2
    got = describe.exact_quantiles(spark.range(4500).selectExpr("id", "id % 1500 AS g"), ["id"], (0.5,), "g")
    assert {(int(r.grp), r.value) for r in got.collect()} == {(g, g + 1500.0) for g in range(1500)}


def test_margins_of_billions(spark):
    counts = spark.createDataFrame([("a", "x", 4 * 10**9), ("a", "y", 10**9), ("b", "x", 10**9), ("b", "y", 4 * 10**9)], "level string, grp string, n bigint")
    row = association.chi_square(counts.withColumn("k", F.lit(1)), ["k"]).first()
    assert row.statistic == pytest.approx(3.6e9) and row.dof == 1


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
@pytest.mark.parametrize("kind", ["random", "few values", "one value", "two rows"])
def test_quantiles_are_exact_whatever_the_sketch(spark, accuracy, kind):
    rnd = random.Random(11)
    n = 2 if kind == "two rows" else 5000
    draw = {"random": lambda: rnd.gauss(0, 1), "few values": lambda: float(rnd.choice([1, 2, 2, 2, 9])), "one value": lambda: 4.0, "two rows": lambda: rnd.random()}[kind]
    data = {"a": [draw() for _ in range(n)], "b": [draw() for _ in range(n // 2)]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs] + [("a", None)], "g string, v double").repartition(5)
    probs = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    got = {(r.grp, r.prob): r.value for r in describe.exact_quantiles(df, ["v"], probs, "g", accuracy).collect()}
    for g, vs in data.items():
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.quantile(vs, p)), abs=1e-12), (g, p)


def test_histogram_counts_every_value_once(spark):
    df = spark.createDataFrame([(float(v), 5.0) for v in range(11)] + [(None, None)], "v double, same double")
    rows = {(r.variable, r.bin): (r.low, r.high, r.n) for r in describe.histogram(df, ["v", "same"], 5).collect()}
    assert [rows[("v", b)][2] for b in range(5)] == [2, 2, 2, 2, 3] and rows[("v", 4)][:2] == (8.0, 10.0)
    assert rows[("same", 0)][2] == 11


def test_profile(spark):
    rows = [(i, "a" if i else "b", None if i % 4 == 0 else float(i % 37), 100.0 if i == 5 else float(i % 30)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, k string, v double, w double")
    out = {r.variable: r for r in describe.profile_columns(df).collect()}
    assert out["id"].distinct_values == 200 and out["id"].minimum == 0 and out["id"].maximum == 199 and out["id"].median == 99.5
    assert (out["k"].kind, out["k"].rare_levels, out["k"].mode, out["k"].mode_count) == ("factor", "b", "a", 199)
    assert (out["v"].missing, out["v"].missing_percent, out["v"].kind) == (50, 25.0, "double")
    assert (out["w"].outliers, out["w"].outlier_values) == (1, 1) and out["v"].outliers == 0


def simulated(spark, n=20000):
    """Two covariates act on treatment and outcome; the true risk difference follows from the chances themselves."""
    rnd = np.random.default_rng(1)
    w1, w2 = rnd.normal(size=n), rnd.integers(0, 3, n)
    expit = lambda x: 1 / (1 + np.exp(-x))
    a = rnd.random(n) < expit(0.4 * w1 - 0.3 * w2)
    p1, p0 = (expit(-1 + 0.8 * t + 0.7 * w1 + 0.4 * (w2 == 2)) for t in (1, 0))
    y = rnd.random(n) < np.where(a, p1, p0)
    df = spark.createDataFrame([(int(v), int(t), float(x), str(k)) for v, t, x, k in zip(y, a, w1, w2)], "y int, a int, w1 double, w2 string")
    return df, p1.mean(), p0.mean()


def test_tmle_finds_a_known_effect(spark):
    df, p1, p0 = simulated(spark)
    rows = {r.estimand: r for r in tmle.tmle_binary(df, "y", "a", ["w1"], ["w2"]).collect()}
    truth = {"risk difference": p1 - p0, "relative risk": p1 / p0, "odds ratio": p1 * (1 - p0) / (p0 * (1 - p1))}
    assert set(rows) == set(truth)
    for name, r in rows.items():
        scale = 1 if name == "risk difference" else truth[name]
        assert 0.003 < r.std_error < 0.05 and abs(r.estimate - truth[name]) < 4 * r.std_error * scale
        assert r.ci_low < r.estimate < r.ci_high and r.n == 20000
    crude = df.groupBy("a").agg(F.avg("y").alias("m")).orderBy("a").collect()
    assert abs(crude[1].m - crude[0].m - truth["risk difference"]) > 4 * rows["risk difference"].std_error


def test_tmle_of_two_treatments_and_its_errors(spark):
    df, *_ = simulated(spark, 2000)
    named = df.withColumn("t", F.when(F.col("w2") == "2", "third").when(F.col("a") == 1, "b").otherwise("a"))
    two = {r.estimand: r.estimate for r in tmle.tmle_binary(named, "y", "t", ["w1"], treatments=("a", "b")).collect()}
    same = {r.estimand: r.estimate for r in tmle.tmle_binary(df.filter("w2 <> '2'"), "y", "a", ["w1"]).collect()}
    assert two == pytest.approx(same)
    with pytest.raises(Exception, match="must be 0 or 1"):
        tmle.tmle_binary(df.withColumn("a", F.col("a") + 1), "y", "a", ["w1"])
    with pytest.raises(ValueError, match="one value"):
        tmle.tmle_binary(df.withColumn("y", F.lit(1)), "y", "a", ["w1"])


def test_a_group_may_be_called_overall(spark):
    df = from_counts(spark, [("x", "Overall", 1), ("y", "Overall", 3), ("x", "b", 4)], "k string, g string").withColumn("v", F.lit(1.0))
    rows = {(r.variable, r.level, r.grp, r.overall): (r.n, r.percent) for r in balance.table_one(df, "g", ["k"], ["v"]).collect()}
    assert rows[("k", "x", "Overall", False)] == (1, 25.0) and rows[("k", "x", "Overall", True)] == (5, 62.5)
    assert rows[("v", None, "Overall", False)][0] == 4 and rows[("v", None, "Overall", True)][0] == 8


def test_no_columns_and_a_single_group(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0)], "g string, k string, v double")
    assert balance.smd_pairs(df, "g").count() == 0 == balance.smd_pairs(df, "g", ["v"], ["k"]).count()
    assert association.chi_square_pairs(df, "g", ["k"]).count() == 0 == association.welch_t_pairs(df, "g", ["v"]).count()
    assert association.chi_square_by_stratum(df, "k", "g").count() == 0
    assert {r.variable for r in balance.table_one(df, "g", [], ["v"]).collect()} == {"v"}
    assert {r.variable for r in balance.table_one(df, "g", ["k"], []).collect()} == {"k"}
    assert balance.table_one_tests(df, "g", [], []).count() == 0


def test_not_a_number(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", float("nan")), ("a", None)], "g string, v double")
    rows = {r.bin: r.n for r in describe.histogram(df, ["v"], 2).collect()}
    assert rows == {0: 1, 1: 1, None: 1}
    assert describe.exact_quantiles(df, ["v"], (0.5,)).first().value == 2.0
    assert groups.moments(df, ["v"], "g").first().mean == 2.0


def test_missing_is_not_the_text_na(spark):
    df = spark.createDataFrame([("NA",), (None,), (None,)], "x string").withColumnRenamed("x", "it's")
    assert {(r.level, r.missing): r.n for r in describe.category_counts(df, ["it's"]).collect()} == {("NA", False): 1, ("NA", True): 2}
    assert groups.level_counts(df.withColumn("g", F.lit("a")), ["it's"], "g").first().n == 1
    assert describe.missing_percent(df).first().missing == 2


@pytest.mark.parametrize("accuracy", [10, 100, 100_000])
def test_quantiles_whatever_the_sketch(spark, accuracy):
    """A coarse sketch, many ties, steep tails and groups of one row or none: always the exact quantile."""
    rng = np.random.default_rng(5)
    data = {"steep": np.exp(rng.normal(0, 6, 3000)), "ties": rng.integers(0, 4, 500) * 1.0, "one": np.array([3.5]), "gone": np.array([])}
    rows = [(g, float(x)) for g, xs in data.items() for x in xs] + [("gone", None), ("ties", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = (0.0, 0.01, 0.5, 0.9, 1.0)
    got = {(r.grp, r.prob): r.value for r in describe.exact_quantiles(df, ["x"], probs, "g", accuracy).collect()}
    want = {(g, q): float(np.quantile(xs, q)) for g, xs in data.items() if len(xs) for q in probs}
    assert got == pytest.approx(want, rel=1e-12)


def test_blocks_of_groups_change_nothing(spark, monkeypatch):
    rows = [(f"g{i * i % 23}", f"l{i % 3 if i % 23 % 2 else i % 5}", float(i % 11), None if i % 4 else f"r{i % 2}") for i in range(500)]
    df = spark.createDataFrame([*rows, (None, "l1", 1.0, "r0"), ("only", "l9", None, None)], "g string, c string, x double, rare string").cache()
    calls = (
        lambda pairs: association.welch_t_pairs(df, "g", ["x"], pairs), lambda pairs: balance.smd_numeric(df, "g", ["x"], pairs),
        lambda pairs: association.chi_square_pairs(df, "g", ["c", "rare"], pairs), lambda pairs: balance.smd_categorical(df, "g", ["c", "rare"], pairs),
        lambda pairs: association.chi_square_by_stratum(df, "c", "g", pairs),
    )

    def answers(call, pairs=None):
        return sorted(str(tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r)) for r in call(pairs).collect())

    once = [answers(c) for c in calls]
    given = [("g1", "g0"), ("g2", "only")]
    asked = [answers(c, given) for c in calls]
    monkeypatch.setattr(groups, "BLOCK_GROUPS", 2)
    assert [answers(c) for c in calls] == once
    assert [answers(c, given) for c in calls] == asked and all(asked)


def test_every_pair_of_many_groups_comes_once(spark):
    n = 2500
    df = spark.range(4 * n).selectExpr(f"concat('g', id % {n}) AS g", "CAST(id % 7 AS double) AS x")
    found = balance.smd_numeric(df, "g", ["x"])
    assert found.agg(F.count("*"), F.count_distinct("group1", "group2"), F.count_if(F.col("group1") < F.col("group2"))).first() == (n * (n - 1) // 2,) * 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
