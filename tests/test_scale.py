"""Plans and skew: what must hold however large the tables are."""

import pytest
from pyspark.sql import functions as F

from cohortry.operators import events, exposure, flags, joins, outcome
from cohortry.operators.cohort import acceptable_cohort, research_dataset
from cohortry.operators.summaries import summarise_events
from cohortry.plans import QUERIES
from cohortry.plans.cohorts import covariates, study
from cohortry.plans.views import CONDITIONS, MEDICATIONS, Views
from cohortry.session import shared_dir
from cohortry.sources.tables import write_table

from .conftest import SMALL
from .helpers import codes, day

# Each takes part of its work into Python on result rows only.
TAIL_PROBABILITIES = {"chi_square_pairs", "chi_square_by_stratum", "welch_t_pairs", "table_one_tests", "case_chi_square", "case_welch_t"}
FITTED = {"tmle_binary", "tmle_binary_covariates", "case_tmle"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_pairing_of_everything_and_no_python_per_row(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert ("ArrowEvalPython" in text) == (name in TAIL_PROBABILITIES)


@pytest.fixture(scope="module")
def stored(spark):
    """Event tables as files, with patients, so that scans can be counted."""
    v = Views(spark, SMALL)
    paths = {n: shared_dir(spark) for n in ("drug_issue", "observation", "patient")}
    return v, {n: write_table(getattr(v, n), p) for n, p in paths.items()}, paths


def test_each_event_table_is_scanned_once(stored):
    v, t, paths = stored
    text = plan(research_dataset(t["patient"], t["drug_issue"], t["observation"], study(v), covariates(v)))
    for name in paths:
        assert text.count(paths[name].rsplit("/", 1)[1]) == 1, name
    text = plan(flags.baseline_exposure_flags(
        t["patient"].withColumns({"study_entry_date": F.col("regstartdate"), "index_date": F.col("regenddate")}),
        t["drug_issue"], v.medication_lists, MEDICATIONS,
    ))
    assert text.count(paths["drug_issue"].rsplit("/", 1)[1]) == 1


def test_only_needed_columns_are_read_and_dates_are_pushed_down(stored):
    _, t, _ = stored
    text = plan(t["drug_issue"].filter(F.col("issuedate") >= F.lit("1999-01-01").cast("date")).select("patid"))
    assert "ReadSchema: struct<patid:bigint,issuedate:date>" in text and "GreaterThanOrEqual(issuedate" in text
    v = stored[0]
    text = plan(exposure.exposure_profile(t["drug_issue"], v.exposure_codes, duration=None))
    assert "ReadSchema: struct<patid:bigint,prodcodeid:bigint,issuedate:date>" in text


def test_cohort_without_broadcasts_is_the_same(spark, monkeypatch):
    v = Views(spark, SMALL)
    columns = ["patid", "first_exposure_date", "outcome", "outcome_date"]
    small = acceptable_cohort(v.patient, v.drug_issue, v.observation, study(v)).select(columns).collect()
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = acceptable_cohort(v.patient, v.drug_issue, v.observation, study(v)).select(columns)
        assert "BroadcastHashJoin" not in plan(big)
        assert sorted(big.collect()) == sorted(small) and small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all events belong to one patient, a third of those on one day."""
    hot = "id % 3 = 0"
    return spark.range(0, N, numPartitions=6).selectExpr(
        f"CASE WHEN {hot} THEN 'hot' ELSE concat('p', id % 100) END AS patid", "CASE WHEN id % 7 = 0 THEN 'x' ELSE 'y' END AS code",
        f"CASE WHEN {hot} AND id % 9 = 0 THEN DATE '2010-06-01' ELSE date_add(DATE '2010-01-01', CAST(id * 31 % 1000 AS INT)) END AS d",
        "CAST(NULL AS DATE) AS e", "CAST(id * 17 % 4000 AS STRING) AS value", "'276' AS numunitid",
    )


def pairs(rows, key="patid"):
    return {r[key]: r for r in rows.collect()}


def test_hot_patient_in_first_and_last_records(skewed):
    local = {}
    for r in skewed.select("patid", "d", "code").collect():
        local.setdefault(r.patid, []).append((r.d, r.code))
    first = pairs(events.first_event(skewed.select("patid", "d", "code"), "d"))
    last = pairs(events.last_event(skewed.select("patid", "d", "code"), "d"))
    assert {p: (r.d, r.code) for p, r in first.items()} == {p: min(v) for p, v in local.items()}
    assert {p: (r.d, r.code) for p, r in last.items()} == {p: max(v) for p, v in local.items()}


def test_hot_patient_reaches_the_shuffle_reduced(spark, skewed):
    """No more rows per patient and map task leave the scan than there are patients."""
    df = events.first_event(skewed.select("patid", "d", "code"), "d")
    df.collect()
    text = plan(df)
    assert text.count("Aggregate(") >= 2 and "Window" not in text


def test_hot_patient_in_outcome_and_flags(spark, skewed):
    rows = skewed.selectExpr("patid", "code AS medcodeid", "d AS obsdate", "e AS enterdate", "value", "numunitid")
    names = [r.patid for r in rows.select("patid").distinct().collect()]
    people = spark.createDataFrame([(n, "1", day("2010-03-01"), day("2011-03-01")) for n in names], "patid string, gender string, study_entry_date date, index_date date")
    rules = outcome.OutcomeRules(codes(spark, "m", ("x", "t")), codes(spark, "a", ("none", "t")), codes(spark, "b", ("none", "t")))
    got = pairs(outcome.add_outcome(people, rows, rules))
    used = pairs(flags.baseline_exposure_flag(people, rows, codes(spark, "f", ("y", "t")), "used", code="medcodeid", dates=("obsdate", "enterdate")))
    best, flag = {}, {n: 0 for n in names}
    for r in rows.collect():
        value = float(r.value)
        level = 0 if value <= 1280 else 1 if value <= 3200 else 2
        if r.medcodeid == "x" and level:
            best[r.patid] = min(best.get(r.patid, (r.obsdate, -level)), (r.obsdate, -level))
        if r.medcodeid == "y" and day("2010-03-01") <= r.obsdate <= day("2011-03-01"):
            flag[r.patid] = 1
    assert {n: (got[n].outcome_date, -got[n].outcome) for n in names if got[n].outcome} == best
    assert {n: used[n].used for n in names} == flag


def test_day_lists_are_bounded_by_days(spark, skewed):
    rows = skewed.selectExpr("patid", "code AS prodcodeid", "d AS issuedate", "e AS enterdate")
    part = flags.medication_part(codes(spark, "l", ("x", "t"), ("y", "t")), ["l"])
    days = pairs(summarise_events(rows, [part], "prodcodeid", ("issuedate", "enterdate")))
    want = rows.filter("patid = 'hot'").select("issuedate").distinct().count()
    assert len(days["hot"]["_days"]) == want < N // 3


def test_conditions_of_a_hot_patient(spark, skewed):
    rows = skewed.selectExpr("patid", "concat('Brand#', 11 + CAST(value AS INT) % 10) AS medcodeid", "d AS obsdate", "e AS enterdate", "value", "numunitid")
    v = Views(spark, SMALL)
    for mode in flags.MODES:
        got = pairs(flags.earliest_condition(rows, v.condition_lists, CONDITIONS, mode))
        first = rows.agg(F.min(F.when(F.col("patid") == "hot", F.col("obsdate"))).alias("d")).first().d
        for i, c in enumerate(CONDITIONS):
            mine = rows.filter(f"patid = 'hot' AND medcodeid = 'Brand#{11 + i}'").agg(F.min("obsdate").alias("d")).first().d
            want = mine if mode == "earliest" or mine == first else None
            assert got["hot"][f"obsdate_{c}"] == want
