import pytest
from pyspark.sql import functions as F

from cohortry.operators import cohort, exposure, flags, outcome
from cohortry.plans.cohorts import study
from cohortry.plans.views import Views

from .helpers import codes, day, drugs, observations, patients, result


@pytest.fixture(scope="module")
def statins(spark):
    return codes(spark, "exposure", ("s1", "Simvastatin"), ("s1", "Simvastatin"), ("s2", "Simvastatin"), ("a1", "Atorvastatin"))


@pytest.fixture(scope="module")
def issues(spark):
    return drugs(
        spark,
        ("tie", "s1", "01/06/2012", None, "28"), ("tie", "a1", "01/06/2012", None, None),
        ("one", "s1", "01/02/2011", None, "28"), ("one", "s2", "01/01/2011", None, "x"), ("one", "s1", "01/03/2011", None, None),
        ("null", "s1", None, "01/01/2011", "5"), ("null", "s1", "02/01/2011", None, "30"),
        ("undated", "s1", None, "01/01/2011", None), ("bad", "a1", "2011-01-01", None, None), ("other", "zz", "01/01/2011", None, None),
    )


PEOPLE = [(p, "1", "1950", None, None, "01/01/2010", None, "1") for p in ("tie", "one", "null", "undated", "bad", "other", "none")]


def test_first_exposure(spark, statins, issues):
    out = exposure.add_first_exposure(patients(spark, *PEOPLE), issues, statins)
    assert result(out, "first_exposure_date", "drugsubstancename", "time_to_first_exposure") == {
        "tie": (day("2012-06-01"), "Atorvastatin", 882), "one": (day("2011-01-01"), "Simvastatin", 365),
        "null": (day("2011-01-02"), "Simvastatin", 366), "undated": (None, None, None), "bad": (None, None, None),
        "other": (None, None, None), "none": (None, None, None),
    }


def test_first_exposure_names_missing_columns(spark, statins, issues):
    people = patients(spark, *PEOPLE)
    with pytest.raises(ValueError, match="drugs must contain columns: issuedate"):
        exposure.add_first_exposure(people, issues.drop("issuedate"), statins)
    with pytest.raises(ValueError, match="codes must contain columns: term"):
        exposure.add_first_exposure(people, issues, statins.drop("term"))


def test_single_class_counts_undated_issues_too(spark, statins, issues):
    kept = exposure.require_single_class(patients(spark, *PEOPLE), issues, statins)
    assert sorted(r.patid for r in kept.collect()) == ["bad", "null", "one", "undated"]


def test_lookback_of_exactly_a_year(spark):
    df = spark.createDataFrame([("a", day("2011-01-01"), 364), ("b", day("2011-01-01"), 365), ("c", None, None)], "patid string, first_exposure_date date, time_to_first_exposure int")
    assert result(exposure.require_lookback(df), "study_entry_date") == {"b": day("2010-01-01")}


def test_period_and_adult_limits(spark):
    df = spark.createDataFrame(
        [("a", "1992", day("2010-07-31")), ("b", "1992", day("2010-07-30")), ("c", "1950", day("2010-01-01")), ("d", "1950", day("2009-12-31")),
         ("e", "1950", day("2020-03-31")), ("f", "1950", day("2020-04-01")), ("g", "1950", None), ("h", None, day("2011-01-01"))],
        "patid string, yob string, first_exposure_date date",
    )
    assert sorted(result(exposure.require_period(df, "2010-01-01", "2020-03-31"), "yob")) == ["a", "b", "c", "e", "h"]
    assert sorted(result(exposure.require_adult(df), "yob")) == ["a", "c", "d", "e", "f"]


def test_exclusion_is_strictly_after_entry(spark):
    people = spark.createDataFrame([(p, day("2010-06-01")) for p in "abcde"], "patid string, study_entry_date date")
    events = observations(
        spark, ("a", "p", "01/06/2010", None, None, None), ("b", "p", "02/06/2010", None, None, None),
        ("c", "p", None, "02/06/2010", None, None), ("d", "p", "31/05/2010", "09/09/2011", None, None), ("e", "q", "02/06/2011", None, None, None),
    )
    kept = cohort.exclude_events_after(people, events, codes(spark, "x", ("p", "pregnant"), ("p", "pregnant")))
    assert sorted(result(kept, "study_entry_date")) == ["a", "d", "e"]


def test_study_end(spark, statins):
    people = spark.createDataFrame(
        [("dur", None, None, None), ("text", None, None, None), ("death", "01/02/2012", None, None), ("left", None, "01/01/2012", None),
         ("outcome", None, None, day("2011-05-05")), ("late", None, None, None), ("never", None, None, None)],
        "patid string, emis_ddate string, regenddate string, outcome_date date",
    )
    rows = [
        ("dur", "s1", "01/01/2012", None, "30"), ("dur", "s1", "01/01/2012", None, "10"), ("dur", "s1", "01/01/2011", None, "900"),
        ("text", "s1", "01/01/2012", None, "one month"), ("late", "s1", "01/03/2020", None, "28"),
        *[(p, "s1", "01/01/2012", None, "30") for p in ("death", "left", "outcome")],
    ]
    out = exposure.add_study_end(people, "2020-03-31", drugs(spark, *rows), statins)
    assert result(out, "censor_date", "study_exit_date") == {
        "dur": (day("2012-05-30"), day("2012-05-30")), "text": (day("2012-06-29"), day("2012-06-29")),
        "death": (day("2012-05-30"), day("2012-02-01")), "left": (day("2012-05-30"), day("2012-01-01")),
        "outcome": (day("2012-05-30"), day("2011-05-05")), "late": (day("2020-07-27"), day("2020-03-31")),
        "never": (None, day("2020-03-31")),
    }


def test_outcome_after_the_end_counts_as_none(spark):
    df = spark.createDataFrame(
        [("a", 1, day("2011-01-02"), day("2011-01-01")), ("b", 2, day("2011-01-01"), day("2011-01-01")), ("c", 0, None, day("2011-01-01"))],
        "patid string, outcome int, outcome_date date, study_exit_date date",
    )
    assert result(exposure.censor_outcome(df), "outcome", "outcome_date") == {"a": (0, None), "b": (2, day("2011-01-01")), "c": (0, None)}


@pytest.fixture(scope="module")
def rules(spark):
    def build(**options):
        return outcome.OutcomeRules(
            codes(spark, "ck", ("ck", "creatine kinase"), ("ck", "creatine kinase")), codes(spark, "m", ("myo", "myopathy")),
            codes(spark, "r", ("rhabdo", "rhabdomyolysis")), **options,
        )

    return build


EVENTS = [
    ("m_edge", "ck", "01/01/2011", None, "1280", "276"), ("m_mid", "ck", "01/01/2011", None, "1281", "276"),
    ("m_top", "ck", "01/01/2011", None, "3201", "276"), ("f_edge", "ck", "01/01/2011", None, "800", "276"),
    ("f_mid", "ck", "01/01/2011", None, "801", "276"), ("f_top", "ck", "01/01/2011", None, "2001", "276"),
    ("converted", "ck", "01/01/2011", None, "2", "155"), ("no_unit", "ck", "01/01/2011", None, "1", None),
    ("odd_unit", "ck", "01/01/2011", None, "1", "9"), ("text_value", "ck", "01/01/2011", None, "high", "276"),
    ("hidden", "ck", "01/01/2011", None, "5", "276"), ("hidden", "myo", "01/01/2012", None, None, None),
    ("entered", "myo", None, "05/05/2012", None, None), ("undated", "myo", None, None, None, None),
    ("undated_first", "myo", None, None, None, None), ("undated_first", "rhabdo", "01/01/2012", None, None, None),
    ("same_day", "myo", "01/01/2011", None, None, None), ("same_day", "rhabdo", "01/01/2011", None, None, None),
    ("same_day", "ck", "01/01/2011", None, "1", "9"), ("neutral", "ck", "01/01/2011", None, "9999", "276"),
    ("neutral_myo", "myo", "01/01/2011", None, None, None), ("other", "zzz", "01/01/2011", None, "9999", "276"),
]
SEX = {"f_edge": "2", "f_mid": "2", "f_top": "2", "neutral": "3", "neutral_myo": None}


def outcomes(spark, rules, mode):
    names = dict.fromkeys([e[0] for e in EVENTS] + ["nobody"])
    people = spark.createDataFrame([(n, SEX.get(n, "1")) for n in names], "patid string, gender string")
    return result(outcome.add_outcome(people, observations(spark, *EVENTS), rules(mode=mode)), "outcome", "outcome_date")


def test_outcome_first_event_above_zero(spark, rules):
    d = day("2011-01-01")
    assert outcomes(spark, rules, "earliest_positive") == {
        "m_edge": (0, None), "m_mid": (1, d), "m_top": (2, d), "f_edge": (0, None), "f_mid": (1, d), "f_top": (2, d),
        "converted": (1, d), "no_unit": (3, d), "odd_unit": (3, d), "text_value": (0, None), "hidden": (1, day("2012-01-01")),
        "entered": (1, day("2012-05-05")), "undated": (1, None), "undated_first": (2, day("2012-01-01")), "same_day": (2, d),
        "neutral": (0, None), "neutral_myo": (1, d), "other": (0, None), "nobody": (0, None),
    }


def test_outcome_very_first_event_only(spark, rules):
    got = outcomes(spark, rules, "first_record")
    assert got["hidden"] == (0, None)
    assert got["undated_first"] == (1, None)
    assert got["same_day"] == (2, day("2011-01-01"))
    assert got["m_top"] == (2, day("2011-01-01"))


def test_outcome_detail_agrees_with_summary(spark, rules):
    """The earliest event above zero, taken from the list of events, gives the same outcome."""
    names = dict.fromkeys(e[0] for e in EVENTS)
    people = spark.createDataFrame([(n, SEX.get(n, "1")) for n in names], "patid string, gender string")
    best = {}
    for r in outcome.outcome_events(people, observations(spark, *EVENTS), rules()).collect():
        if r.outcome_code and r.outcome_code > 0:
            key = (r.outcome_date is None, r.outcome_date or day("1900-01-01"), {2: 0, 1: 1, 3: 2}[r.outcome_code])
            best[r.patid] = min(best.get(r.patid, (key, r.outcome_code)), (key, r.outcome_code))
    want = {n: best[n][1] if n in best else 0 for n in names}
    got = outcomes(spark, rules, "earliest_positive")
    assert {n: got[n][0] for n in names} == want


def test_outcome_rules_are_checked(rules):
    with pytest.raises(ValueError):
        rules(mode="latest")
    with pytest.raises(ValueError):
        rules(accepted=())


def test_units_to_convert_need_an_accepted_target(spark, rules):
    people = spark.createDataFrame([("converted", "1")], "patid string, gender string")
    out = outcome.add_outcome(people, observations(spark, *EVENTS), rules(accepted=(154,)))
    assert result(out, "outcome") == {"converted": 3}


def test_prior_outcome(spark):
    first = day("2011-01-01")
    df = spark.createDataFrame(
        [("before", 1, day("2010-12-31"), first), ("same", 1, first, first), ("after", 2, day("2011-01-02"), first), ("none", 0, None, first),
         ("undefined", 3, day("2012-01-01"), first)],
        "patid string, outcome int, outcome_date date, first_exposure_date date",
    )
    assert sorted(result(outcome.exclude_prior_outcome(df), "outcome")) == ["after", "none", "same"]


def test_baseline_flags_include_both_ends(spark):
    people = spark.createDataFrame([(p, day("2010-01-01"), day("2011-01-01")) for p in "abcdef"], "patid string, study_entry_date date, index_date date")
    rows = drugs(
        spark, ("a", "x", "01/01/2010", None, None), ("b", "x", "01/01/2011", None, None), ("c", "x", "31/12/2009", None, None),
        ("d", "x", "02/01/2011", "01/06/2010", None), ("e", "x", None, "01/06/2010", None), ("e", "y", "01/07/2010", None, None),
    )
    lists = codes(spark, "x's", ("x", "t"), ("x", "t")).unionByName(codes(spark, "both", ("x", "t"), ("y", "t")))
    out = flags.baseline_exposure_flags(people, rows, lists, ["x's", "both"])
    assert result(out, "x's", "both") == {"a": (1, 1), "b": (1, 1), "c": (0, 0), "d": (0, 0), "e": (1, 1), "f": (0, 0)}
    with pytest.raises(ValueError, match="both"):
        flags.baseline_exposure_flags(out, rows, lists, ["both"])
    single = flags.baseline_exposure_flag(people, rows, codes(spark, "z", ("y", "t")), "used")
    assert result(single, "used") == {"a": 0, "b": 0, "c": 0, "d": 0, "e": 1, "f": 0}


CONDITION_EVENTS = [
    ("first", "as", "01/01/2010", None, None, None), ("first", "zz", "01/01/2011", None, None, None),
    ("second", "zz", "01/01/2009", None, None, None), ("second", "as", "01/01/2010", None, None, None),
    ("late", "as", "02/06/2010", None, None, None), ("on_day", "as", "01/06/2010", None, None, None),
    ("entered", "as", None, "01/01/2010", None, None), ("undated", "as", None, None, None, None),
    ("undated_other", "zz", None, None, None, None), ("undated_other", "as", "01/01/2010", None, None, None),
    ("none", "zz", "01/01/2010", None, None, None),
]


@pytest.mark.parametrize("mode, yes", [
    ("earliest", {"first", "second", "on_day", "entered", "undated_other"}), ("first_record", {"first", "on_day", "entered"}),
])
def test_condition_flags(spark, mode, yes):
    names = dict.fromkeys(e[0] for e in CONDITION_EVENTS)
    people = spark.createDataFrame([(n, day("2010-06-01")) for n in names], "patid string, index_date date")
    out = flags.condition_flags(people, observations(spark, *CONDITION_EVENTS), codes(spark, "asthma", ("as", "t"), ("as", "t")), ["asthma"], mode=mode)
    assert {p for p, v in result(out, "asthma").items() if v == 1} == yes
    assert set(result(out, "asthma").values()) == {0, 1}


def test_latest_measurement(spark):
    rows = observations(
        spark, ("a", "bmi", "01/01/2010", None, "25", "1"), ("a", "bmi", "01/01/2011", None, "27", "1"), ("a", "bmi", "01/01/2011", None, "28", "1"),
        ("a", "bmi", "01/01/2012", None, "71", "1"), ("b", "bmi", None, "01/01/2010", "6.7", "1"), ("c", "bmi", "01/01/2010", None, "70", "2"),
        ("d", "zz", "01/01/2010", None, "30", "1"), ("e", "bmi", "01/01/2010", None, "x", "1"), ("f", "bmi", "01/01/2010", None, "70.0", None),
    )
    units = spark.createDataFrame([(1, "kg/m2"), (2, "mmol/L"), (3, None)], "numunitid int, Description string")
    bmi = codes(spark, "bmi", ("bmi", "t"), ("bmi", "t"))
    assert result(flags.latest_measurement(rows, bmi, units), "obsdate_BMI", "BMI") == {"a": (day("2011-01-01"), 28.0), "b": (day("2010-01-01"), 6.7)}
    assert set(result(flags.latest_measurement(rows, None, units), "BMI")) == {"a", "b", "d"}
    people = spark.createDataFrame([("a", day("2010-12-31")), ("b", day("2009-01-01"))], "patid string, index_date date")
    limited = flags.latest_measurement(rows, bmi, units, patients=people, as_of="index_date")
    assert result(limited, "BMI") == {"a": 25.0}


# Patients left after each step at each size, from an independent count on the same views.
FUNNEL = {
    "0.001": [150, 135, 90, 76, 53, 33, 15], "0.01": [1500, 1350, 702, 618, 465, 296, 132], "0.1": [15000, 13500, 6577, 5802, 4192, 2500, 1296],
}


@pytest.mark.parametrize("sf", FUNNEL)
def test_attrition(spark, sf):
    v = Views(spark, f"/root/testdata/sf{sf}")
    rows = cohort.cohort_attrition(v.patient, v.drug_issue, None, study(v, with_outcome=False)).orderBy("step_no").collect()
    assert [r.remaining for r in rows] == FUNNEL[sf]
    assert [r.excluded for r in rows] == [0] + [a - b for a, b in zip(FUNNEL[sf], FUNNEL[sf][1:])]


def test_stepwise_and_one_pass_cohorts_agree(spark, views):
    """The operators applied one after the other give the cohort of the single pass."""
    v, s = views, study(views)
    step = exposure.add_first_exposure(v.patient.filter("acceptable = '1'"), v.drug_issue, v.exposure_codes)
    step = exposure.require_adult(exposure.require_period(exposure.require_lookback(step), s.start, s.end))
    step = cohort.exclude_events_after(step, v.drug_issue, v.exclusion_codes, code="prodcodeid", dates=("issuedate", "enterdate"))
    step = outcome.exclude_prior_outcome(outcome.add_outcome(step, v.observation, s.outcome))
    step = exposure.require_single_class(step, v.drug_issue, v.exposure_codes)
    whole = cohort.acceptable_cohort(v.patient, v.drug_issue, v.observation, s)
    columns = ["patid", "first_exposure_date", "drugsubstancename", "study_entry_date", "outcome", "outcome_date"]
    assert whole.count() > 0
    assert not whole.select(columns).exceptAll(step.select(columns)).count() and not step.select(columns).exceptAll(whole.select(columns)).count()


def test_attrition_takes_any_conditions(spark):
    df = spark.range(10).withColumn("x", F.when(F.col("id") > 2, F.col("id")))
    rows = cohort.attrition_table(df, [("known", F.col("x") > 0), ("even", F.col("x") % 2 == 0)]).collect()
    assert [tuple(r) for r in rows] == [(0, "all", 10, 0), (1, "known", 7, 3), (2, "even", 3, 4)]
