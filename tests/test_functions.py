import math

import pytest
from pyspark.sql import functions as F

from cohortry.functions import clean, dates, tails

from .helpers import day


def one(spark, expression, **columns):
    schema = ", ".join(f"{n} {kind}" for n, (kind, _) in columns.items())
    return spark.createDataFrame([tuple(v for _, v in columns.values())], schema).select(expression.alias("x")).first().x


def test_dates_are_parsed_once_and_bad_text_gives_null(spark):
    df = spark.createDataFrame([("31/01/2020",), ("2020-01-31",), ("31/02/2020",), (None,)], "d string")
    once = dates.parse_dates(df, "d")
    assert [r.d for r in once.collect()] == [day("2020-01-31"), None, None, None]
    assert [r.d for r in dates.parse_dates(once, "d").collect()] == [day("2020-01-31"), None, None, None]


def test_effective_date_falls_back(spark):
    df = spark.createDataFrame([(day("2020-01-01"), day("2020-02-02")), (None, day("2020-02-02")), (None, None)], "a date, b date")
    assert [r[0] for r in df.select(dates.effective_date("a", "b")).collect()] == [day("2020-01-01"), day("2020-02-02"), None]


@pytest.mark.parametrize("yob, mob, at, age", [
    ("1980", None, "2010-07-31", 29), ("1980", None, "2010-08-01", 30), ("1980", "2", "2000-03-01", 20),
    ("1980", "13", "2010-01-01", None), ("x", None, "2010-01-01", None),
])
def test_age(spark, yob, mob, at, age):
    df = spark.createDataFrame([(yob, mob, day(at))], "yob string, mob string, at date")
    assert df.select(dates.age_at("at").alias("x")).first().x == age


def test_adult_from_31_july(spark):
    assert one(spark, dates.birthday_bound(), yob=("string", "1990")) == day("2008-07-31")
    assert one(spark, dates.birthday_bound(), yob=("string", "none")) is None


@pytest.mark.parametrize("gender, value, level", [
    ("1", "1280", 0), ("1", "1280.1", 1), ("1", "3200", 1), ("1", "3201", 2), ("2", "800", 0), ("2", "801", 1), ("2", "2000", 1),
    ("2", "2000.5", 2), ("3", "5000", None), (None, "5000", None), ("1", None, None), ("1", "high", None),
])
def test_bands(spark, gender, value, level):
    assert one(spark, clean.threshold_by_group(), gender=("string", gender), value=("string", value)) == level


@pytest.mark.parametrize("unit, level", [("276", None), ("154", None), ("9", 3), (None, 3), ("IU", 3)])
def test_unit_gate(spark, unit, level):
    assert one(spark, clean.unit_gate(), numunitid=("string", unit)) == level


def test_unit_convert(spark):
    df = spark.createDataFrame([("2", "155"), ("2", "277"), ("2", "276"), ("x", "155"), ("2", "y")], "value string, numunitid string")
    rows = [(r.value, r.numunitid) for r in clean.unit_convert(df).collect()]
    assert rows == [(2000.0, 276), (2000.0, 276), (2.0, 276), (None, 276), (2.0, None)]


def test_units_must_be_given():
    with pytest.raises(ValueError):
        clean.unit_gate([])


def test_required_and_forbidden_columns(spark):
    df = spark.createDataFrame([(1, 2)], "Patid int, x int")
    assert clean.require_columns(df, ["patid"]) is df
    with pytest.raises(ValueError, match="issuedate"):
        clean.require_columns(df, ["patid", "issuedate"])
    with pytest.raises(ValueError, match="X"):
        clean.forbid_columns(df, ["X"])


def test_recode_of_the_five_treatments(spark):
    df = spark.createDataFrame([(t,) for t in [*clean.TREATMENT_CODES, "other", None]], "t string")
    assert [r[0] for r in df.select(clean.case_recode("t")).collect()] == [1, 2, 3, 4, 5, None, None]


def test_period_ends_are_included(spark):
    df = spark.createDataFrame([(day(d),) for d in ("2009-12-31", "2010-01-01", "2020-03-31", "2020-04-01")] + [(None,)], "d date")
    kept = clean.period_filter(df, "d", "2010-01-01", "2020-03-31")
    assert [str(r.d) for r in kept.collect()] == ["2010-01-01", "2020-03-31"]
    assert clean.period_filter(df, "d", "2010-01-01").count() == 3


def test_value_exclude_drops_null(spark):
    df = spark.createDataFrame([("1",), ("3",), (None,)], "gender string")
    assert [r.gender for r in clean.value_exclude(df, "gender", "3").collect()] == ["1"]


def test_index_by_frequency_then_text(spark):
    df = spark.createDataFrame([("b", 1.5), ("b", 2.5), ("a", 3.5), ("c", 4.5)], "k string, x double")
    rows = {r.x: r.k for r in clean.index_categories(df, keep=["x"]).collect()}
    assert rows == {1.5: 0, 2.5: 0, 3.5: 1, 4.5: 2}


def test_columns_that_are_not_indexed_become_numbers(spark):
    rows = [(str(i % 3), f"{i}.5" if i else "none", i % 2 == 0, i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, x string, b boolean, id long")
    out = clean.index_categories(df, keep=["b"])
    assert out.dtypes == [("k", "int"), ("x", "double"), ("b", "int"), ("id", "bigint")]
    assert {r.id: (r.x, r.b) for r in out.collect()} == {i: (i + 0.5 if i else None, 1 - i % 2) for i in range(30)}
    assert clean.index_categories(df.select("x")).dtypes == [("x", "double")]


def test_only_few_valued_columns_are_indexed(spark):
    df = spark.range(100).select((F.col("id") % 19).alias("few"), (F.col("id") % 20).alias("edge"), "id")
    assert clean.few_valued(df, ["few", "edge", "id"]) == ["few"]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("x", "X", "x_dup")
    assert clean.dedupe_column_names(df).columns == ["x", "X_dup", "x_dup_dup"]
    assert clean.clean_column_names(df.toDF("a b", "c.d", "(e)")).columns == ["a_b", "c_d", "e"]
    assert clean.rename_drop(df.toDF("p", "obsdate_q", "r"), {"p": "s"}, ["R"], "obsdate").columns == ["s"]


def test_tails_with_very_many_degrees_of_freedom(monkeypatch):
    assert tails.f_tail(1.0, 4, 1e12) == pytest.approx(3 * math.exp(-2), rel=1e-9)
    assert tails.f_tail(1.0, 1e12, 4) == pytest.approx(1 - 3 * math.exp(-2), rel=1e-9)
    assert tails.t_two_sided(2.0, 1e12) == pytest.approx(math.erfc(math.sqrt(2)), rel=1e-9)
    assert tails.chi2_tail(1e12, 1e12) == pytest.approx(0.5 - 2 / 3 / math.sqrt(4e12 * math.pi), abs=1e-9)
    assert tails.f_tail(1.0, 1e12, 1e12) == pytest.approx(0.5, abs=1e-9)
    for many in (tails.chi2_tail, tails.t_two_sided):
        stat = {tails.chi2_tail: 1.0002e7, tails.t_two_sided: 3.0}[many]
        assert many(stat, 1e7) == pytest.approx(many(stat, 1e7 + 1), rel=1e-3 if many is tails.chi2_tail else 1e-6)
    for few in (1, 4, 1000, 30000, 5e6):
        stat = 1 + 1 / math.sqrt(few)
        assert tails.f_tail(stat, few, 1e7) == pytest.approx(tails.f_tail(stat, few, 1e7 + 1), rel=1e-5)
        assert tails.f_tail(stat, 1e7, few) == pytest.approx(tails.f_tail(stat, 1e7 + 1, few), rel=1e-5)
    monkeypatch.setattr(tails, "_STEPS", 3)
    with pytest.raises(ArithmeticError, match="did not converge"):
        tails.f_tail(1.0, 400, 1e6)


def test_tails():
    assert tails.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-12)
    assert tails.chi2_tail(10.0, 2) == pytest.approx(math.exp(-5), rel=1e-12)
    assert tails.chi2_tail(0.0, 3) == 1.0
    assert tails.t_two_sided(0.0, 5) == pytest.approx(1.0)
    assert tails.t_two_sided(1.0, 1) == pytest.approx(0.5, rel=1e-12)
    assert tails.t_two_sided(12.706204736432095, 1) == pytest.approx(0.05, rel=1e-9)
    assert tails.f_tail(4.0, 1, 10) == pytest.approx(tails.t_two_sided(2.0, 10), rel=1e-12)
    assert tails.f_tail(3.0, 2, 8) == pytest.approx((1 + 2 * 3.0 / 8) ** -4, rel=1e-12)
