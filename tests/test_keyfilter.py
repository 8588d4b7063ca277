"""The filter of eligible keys: nothing is lost, little passes wrongly, its size is bounded."""

import pytest
from pyspark.sql import functions as F

from cohortry.operators import joins
from cohortry.operators.cohort import acceptable_cohort, research_dataset
from cohortry.operators.flags import with_unit
from cohortry.operators.joins import patient_semi
from cohortry.operators.keyfilter import early_codes, early_filter, early_semi, filter_words
from cohortry.plans.cohorts import covariates, of_study, study
from cohortry.plans.views import RARE, Views
from cohortry.plans.whole import research_early, whole_study

from .conftest import SMALL

N = 40000


@pytest.mark.parametrize("kind", ["long", "string", "date"])
@pytest.mark.parametrize("bits, most", [(16, 0.03), (4, 0.5)])
def test_nothing_is_lost_and_little_passes(spark, kind, bits, most):
    key = {"long": "id", "string": "concat('p', id)", "date": "date_add(DATE '1700-01-01', CAST(id AS INT))"}[kind]
    events = spark.range(N).selectExpr(f"{key} AS patid", "id AS n")
    wanted = events.filter("n % 10 = 3").select("patid")
    left = early_filter(events, wanted, max_bytes=N // 10 * bits // 64 * 32)
    assert left.columns == ["patid", "n"] and left.filter("n % 10 = 3").count() == N // 10
    assert left.filter("n % 10 <> 3").count() <= most * N * 0.9


def test_size_of_the_filter():
    assert filter_words(4) == 1 == filter_words(0) and filter_words(1000) == 250
    assert filter_words(10**6, 32 * 100_000) == 100_000 and filter_words(10**6, 32 * 60_000) is None
    assert filter_words(10**12) is None and filter_words(1, 0) is None
    assert filter_words(10**7) * 32 <= joins.MAX_BROADCAST_BYTES


def test_the_filter_is_broadcast_and_comes_before_the_shuffle(spark):
    events = spark.range(N).selectExpr("id AS patid")
    wanted = spark.range(0, N, 10).selectExpr("id AS patid")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = early_semi(events, wanted, max_bytes=0)
        text = left._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" in text and "Python" not in text
        assert text.index("SortMergeJoin") < text.index("BroadcastHashJoin")  # below it in the plan
        assert left.count() == N // 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_semi_join_of_any_keys(spark):
    events = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (4, "d")], "patid int, _word string")
    keys = spark.createDataFrame([(1,), (1,), (None,), (4,), (9,)], "patid long")
    for wanted in (keys, keys.withColumn("patid", F.col("patid").cast("int")), keys.withColumn("patid", F.col("patid").cast("string"))):
        for limit in (None, 0):
            got = early_semi(events, wanted, max_bytes=limit)
            assert sorted(got.collect()) == [(1, "a"), (1, "a"), (4, "d")] and got.columns == ["patid", "_word"]
    assert early_semi(events, keys.limit(0), max_bytes=0).count() == 0
    assert early_semi(events.limit(0), keys, max_bytes=0).count() == 0


@pytest.mark.parametrize("of, seen", [(study, "observation"), (whole_study, "rare_observation")])
def test_cohort_and_dataset_are_the_same(spark, of, seen):
    v = Views(spark, SMALL)
    tables = v.patient, v.drug_issue, getattr(v, seen)
    late, soon = (acceptable_cohort(*tables, of(v), early=e) for e in (False, True))
    assert late.columns == soon.columns and late.exceptAll(soon).count() == 0 == soon.exceptAll(late).count()
    late, soon = (research_dataset(*tables, of(v), covariates(v), early=e) for e in (False, True))
    assert late.columns == soon.columns and late.exceptAll(soon).count() == 0 == soon.exceptAll(late).count()


def nodes(df) -> str:
    """The optimized plan as text."""
    return df._jdf.queryExecution().optimizedPlan().toString()


def below(text: str, join: str, other: str = "Join Inner") -> bool:
    """Whether a semi join with the text stands below the topmost inner join."""
    lines = text.splitlines()
    top = next(k for k, line in enumerate(lines) if other in line)
    return any("Join LeftSemi" in line and join in line for line in lines[top + 1:])


def test_restricted_events_are_reduced_before_their_tables_meet(spark):
    v = Views(spark, SMALL)
    keys = spark.range(0, 150, 10).selectExpr("id AS patid")
    own = v.of_patients(keys)
    for name in ("drug_issue", "observation", "rare_observation"):
        all_rows, own_rows = (patient_semi(getattr(x, name), keys) for x in (v, own))
        assert below(nodes(all_rows), "(patid#")
        assert below(nodes(own_rows), "xxhash64(l_orderkey")
        assert own_rows.count() > 0 and all_rows.exceptAll(own_rows).count() == 0 == own_rows.exceptAll(all_rows).count()


@pytest.mark.parametrize("limit", [None, 200])
def test_lines_are_not_shuffled_for_parts_without_a_listed_code(spark, monkeypatch, tmp_path, limit):
    tables = {
        "part": spark.range(40).selectExpr("nullif(id, 39) AS p_partkey", "CASE WHEN id <> 5 THEN 'Brand#1' END AS p_brand", "int(25 + id % 10) AS p_size", "'ECONOMY' AS p_type").union(
            spark.createDataFrame([(10, "Brand#2", 30, "LARGE"), (11, "Brand#2", 1, None)], "p_partkey long, p_brand string, p_size int, p_type string")),
        "orders": spark.range(50).selectExpr("nullif(id, 49) AS o_orderkey", "id % 7 AS o_custkey", "timestamp'2000-01-01' AS o_orderdate"),
        "lineitem": spark.range(900).selectExpr(
            "id % 53 AS l_orderkey", "nullif(id % 43, 25) AS l_partkey", "timestamp'2000-02-01' AS l_shipdate", "int(id % 8) AS l_linenumber", "double(id) AS l_extendedprice",
            "CASE id % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'A' END AS l_returnflag"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    if limit:
        monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", limit)
    try:
        v = Views(spark, str(tmp_path))
        own = of_study(v, whole_study(v)).rare_observation
        text = own._jdf.queryExecution().executedPlan().toString()
        if limit:
            assert below(nodes(own), "xxhash64(l_partkey")
        else:
            assert "BroadcastHashJoin [l_partkey" in text and "hashpartitioning(l_partkey" not in text
        got, want = (rows.filter(F.col("medcodeid").isin(list(RARE))) for rows in (own, v.rare_observation))
        assert want.count() > 0 and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
        assert own.count() < v.rare_observation.count() / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_research_shuffles_lines_of_eligible_patients_only(views):
    text = nodes(research_early(views))
    scans = [line for line in text.splitlines() if "Relation [l_orderkey" in line]
    filters = [line for line in text.splitlines() if "Join LeftSemi" in line and "xxhash64(l_orderkey" in line]
    assert len(scans) == len(filters) == 1 and "xxhash64(patid" in text  # drugs are stored by then


def test_listed_codes_reduce_events_before_their_tables_meet(spark):
    v = Views(spark, SMALL)
    lists = v.exposure_codes.unionByName(v.medication_lists)
    rows = early_codes(v.drug_issue, lists, "prodcodeid")
    assert below(nodes(rows), "prodcodeid") and below(nodes(early_filter(v.observation, spark.range(5).selectExpr("id AS patid"))), "xxhash64(patid")
    want = v.drug_issue.join(lists.selectExpr("code AS prodcodeid").distinct(), "prodcodeid").select(rows.columns)
    assert rows.exceptAll(want).count() == 0 == want.exceptAll(rows).count()


@pytest.mark.parametrize("limit", [None, 2000])
def test_codes_of_any_type_keep_their_events(spark, monkeypatch, limit):
    if limit:
        monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", limit)
    events = spark.createDataFrame([(1, "7", "a"), (1, "7", "a"), (2, "007", "b"), (3, None, "c"), (4, "x", "d")], "patid int, code_id string, v string")
    lists = spark.range(7, 207).selectExpr("'l' AS list_name", "id AS code").union(spark.createDataFrame([("l", None), ("m", 7)], "list_name string, code long"))
    for codes in (lists, lists.withColumn("code", F.col("code").cast("string"))):
        got = early_codes(events, codes, "code_id")
        assert got.columns == events.columns and got.filter("code_id = '7'").count() == 2
        if not limit:
            assert got.count() == 2


def test_units_are_marked_without_a_stop_for_semi_joins(spark):
    events = spark.createDataFrame([(1, "276"), (1, "276"), (2, " 9 "), (3, None), (4, "x"), (5, "155")], "patid int, numunitid string")
    units = spark.createDataFrame([(276, "kg/m2"), (276, "kg/m2"), (155, "kg/m2"), (9, "mmol/L"), (None, "kg/m2")], "numunitid int, Description string")
    out = with_unit(events, units)
    assert out.columns == ["patid", "numunitid", "_in_unit"]
    assert sorted(out.collect(), key=str) == [(1, "276", True), (1, "276", True), (2, " 9 ", None), (3, None, None), (4, "x", None), (5, "155", True)]
    assert below(nodes(early_filter(out, spark.range(3).selectExpr("CAST(id AS INT) AS patid"))), "xxhash64", "Join LeftOuter")
