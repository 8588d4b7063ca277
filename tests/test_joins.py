import pytest
from pyspark.sql import functions as F

from cohortry.operators import events, joins, sets
from cohortry.sources.codelists import long_codelist

from .helpers import codes, day


@pytest.fixture(params=["broadcast", "shuffle"])
def either_join(request, monkeypatch):
    """Every join must give the same rows when its small side is over the limit."""
    if request.param == "shuffle":
        monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    return request.param


def frame(spark, rows, schema="patid string, code string"):
    return spark.createDataFrame(rows, schema)


def test_size_check_counts_text(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert joins.fits(df, 100 * (16 + 8 + 100)) and not joins.fits(df, 100 * (16 + 8 + 100) - 1)
    assert joins.at_most(spark.range(5), 5) and not joins.at_most(spark.range(6), 5)


def test_codelist_joins(spark, either_join):
    rows = frame(spark, [("a", "1"), ("a", "1"), ("b", "2"), ("c", "3"), ("d", None)])
    lists = codes(spark, "l", ("1", "x"), ("1", "x"), ("2", "y")).unionByName(codes(spark, "m", ("2", "z")))
    assert sorted(map(tuple, joins.codelist_filter(rows, lists, "code").collect())) == [("a", "1"), ("a", "1"), ("b", "2")]
    assert sorted(map(tuple, joins.codelist_filter(rows, lists, "code", "term").collect())) == [("a", "1", "x"), ("a", "1", "x"), ("b", "2", "y")]
    tagged = joins.tag_events(rows, lists, "code").select("patid", "code", "list_name")
    assert sorted(map(tuple, tagged.collect())) == [("a", "1", "l"), ("a", "1", "l"), ("b", "2", "l"), ("b", "2", "m")]
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert either_join == "shuffle" or "BroadcastHashJoin" in plan


def test_codes_of_two_types_meet_as_text(spark, either_join):
    """A list of numbers with events that have text codes, and the other way round: no error, and 007 is not 7."""
    text = frame(spark, [("a", "7"), ("b", "007"), ("c", "2x"), ("d", None)])
    numbers = spark.createDataFrame([("l", 7, "x")], "list_name string, code int, term string")
    assert joins.codelist_filter(text, numbers, "code").collect() == joins.codelist_filter(text, codes(spark, "l", ("7", "x")), "code").collect()
    assert [tuple(r) for r in joins.codelist_filter(text, numbers, "code", "term").collect()] == [("a", "7", "x")]
    assert [tuple(r) for r in joins.tag_events(text, numbers, "code").select("patid", "code", "list_name").collect()] == [("a", "7", "l")]
    events_by_number = frame(spark, [("a", 7), ("b", 8)], "patid string, code int")
    kept = joins.codelist_filter(events_by_number, codes(spark, "l", ("7", "x"), ("2x", "y")), "code")
    assert kept.dtypes == events_by_number.dtypes and [tuple(r) for r in kept.collect()] == [("a", 7)]
    mixed = long_codelist([numbers, codes(spark, "m", ("2x", "y"))])
    assert sorted(r.code for r in mixed.collect()) == ["2x", "7"]


def test_patient_joins(spark, either_join):
    rows = frame(spark, [("a", "1"), ("a", "2"), ("b", "2"), ("x", "3")])
    people = frame(spark, [("a", "1", "1"), ("b", "2", "0"), ("c", "1", "1")], "patid string, gender string, acceptable string")
    attrs = joins.attach_patient_attrs(rows, people, ["gender"])
    assert sorted((r.patid, r.code, r.gender or "-") for r in attrs.collect()) == [("a", "1", "1"), ("a", "2", "1"), ("b", "2", "2"), ("x", "3", "-")]
    assert sorted(r.code for r in joins.patient_semi(rows, people).collect()) == ["1", "2", "2"]
    assert sorted(r.patid for r in joins.patient_anti(people, rows).collect()) == ["c"]
    assert sorted(r.code for r in joins.acceptable_join(rows, people).collect()) == ["1", "2"]
    assert joins.lookup_join(rows, people.select("patid", "gender"), "patid").count() == 4


def test_ethnicity_drops_patients_without_a_row_unless_told(spark):
    people = frame(spark, [("a", "1"), ("b", "1")])
    groups = frame(spark, [("a", "4")], "patid string, ethnic_6 string")
    assert [r.Ethnic for r in joins.attach_ethnicity(people, groups).collect()] == ["4"]
    assert joins.attach_ethnicity(people, groups, how="left").count() == 2


def test_composite_key_is_not_joined_text(spark):
    left = frame(spark, [("1", "23"), ("12", "3")], "patid string, pracid string")
    right = frame(spark, [("12", "3", "x")], "patid string, pracid string, v string")
    assert [tuple(r) for r in joins.composite_key_join(left, right, ["patid", "pracid"]).collect()] == [("12", "3", "x")]


def test_folds(spark):
    a, b = frame(spark, [("1", "x"), ("2", "y")], "patid string, a string"), frame(spark, [("2", "z"), ("3", "w")], "patid string, b string")
    assert {tuple(r) for r in joins.full_outer_fold([a, b]).select("patid", "a", "b").collect()} == {("1", "x", None), ("2", "y", "z"), ("3", None, "w")}
    assert {tuple(r) for r in joins.left_fold(a, [b]).collect()} == {("1", "x", None), ("2", "y", "z")}
    assert {tuple(r) for r in joins.outer(a, b).collect()} == {("1", "x", None), ("2", "y", "z"), ("3", None, "w")}


def test_first_and_last_records_are_total(spark):
    rows = [("a", day("2011-01-01"), "2"), ("a", day("2011-01-01"), "1"), ("a", None, "0"), ("a", day("2012-01-01"), "5"), ("a", day("2012-01-01"), None), ("b", None, "9")]
    df = spark.createDataFrame(rows, "patid string, d date, x string")
    first = {r.patid: (r.d, r.x) for r in events.first_event(df, "d").collect()}
    last = {r.patid: (r.d, r.x) for r in events.last_event(df, "d").collect()}
    assert first == {"a": (day("2011-01-01"), "1"), "b": (None, "9")}
    assert last == {"a": (day("2012-01-01"), "5"), "b": (None, "9")}


def test_condition_flag_keeps_every_event(spark):
    df = spark.createDataFrame([("a", "1", day("2011-01-01")), ("a", "2", None), ("b", None, None)], "patid string, medcodeid string, obsdate date")
    out = events.condition_flag(df, codes(spark, "l", ("1", "t"), ("1", "t")), "asthma")
    assert out.columns == ["patid", "obsdate_asthma", "asthma"]
    assert sorted((r.patid, r.asthma) for r in out.collect()) == [("a", 0), ("a", 1), ("b", 0)]


def test_diff_counts_copies_both_ways(spark):
    a, b = frame(spark, [("1", "x"), ("1", "x"), ("2", "y")]), frame(spark, [("1", "x"), ("3", "z")])
    assert sorted(map(tuple, sets.diff_frames(a, b).collect())) == [("1", "x", "left"), ("2", "y", "left"), ("3", "z", "right")]
    assert sets.diff_frames(a, a).count() == 0


def test_drop_duplicates_never_varies(spark):
    df = spark.createDataFrame([(i % 3, (i * 7) % 11) for i in range(60)], "k int, v int")
    want = {(0, 0), (1, 0), (2, 0)}
    for parts in (1, 3, 8):
        assert {tuple(r) for r in sets.drop_duplicates(df.repartition(parts), ["k"]).collect()} == want
    assert sets.drop_duplicates(df.select("k"), ["k"]).count() == 3


def test_except_and_union(spark):
    a, b = frame(spark, [("1", "x"), ("1", "y"), ("2", "x")]), spark.createDataFrame([("z", "2")], "code string, patid string")
    assert [r.patid for r in sets.except_keys(a, b).collect()] == ["1"]
    assert ("2", "z") in {tuple(r) for r in sets.union_lists([a, b]).collect()}


def test_events_before_index_include_both_ends(spark):
    people = spark.createDataFrame([("a", day("2011-01-31")), ("c", None)], "patid string, index_date date")
    rows = [("a", day("2011-01-01")), ("a", day("2010-12-31")), ("a", day("2011-01-31")), ("a", day("2011-02-01")), ("a", None), ("b", day("2011-01-15")), ("c", day("2011-01-15"))]
    kept = events.events_before_index(spark.createDataFrame(rows, "patid string, d date"), people, 30, "d")
    assert sorted(str(r.d) for r in kept.collect()) == ["2011-01-01", "2011-01-31"]


def test_fold_loses_nothing_silently(spark):
    one, two = spark.createDataFrame([("p", 10), ("p", 20)], "patid string, x int"), spark.createDataFrame([("p", 99)], "patid string, y int")
    with pytest.raises(Exception, match="holds a patid twice"):
        joins.full_outer_fold([one, two]).collect()
    with pytest.raises(ValueError, match="share column names"):
        joins.full_outer_fold([two, two])


def test_bands_as_a_table(spark, either_join):
    inf, nan = float("inf"), float("nan")
    bands = [("1", None, 0.0, 0), ("1", 0.0, 5.0, 1), ("1", 7.0, None, 2), ("2", 1.0, 2.0, 3), ("3", None, None, 4)]
    bands += [("4", float(i), float(i + 1), i) for i in range(10_000)]
    rows = [(g, x) for g in ("1", "2", "3", "4", "5", None) for x in (-inf, -3.0, 0.0, 0.1, 1.0, 2.0, 5.0, 6.0, 7.0, 7.1, 9_999.5, 10_000.0, 10_001.0, inf, nan, None)]

    def want(g, x):
        if x is None or x != x:
            return None
        return next((c for b, low, high, c in bands if b == g and x > (-inf if low is None else low) and x <= (inf if high is None else high)), None)

    got = joins.band_join(frame(spark, rows, "grp string, x double"), frame(spark, bands, "group string, low double, high double, code int"), "grp", "x")
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str((g, x, want(g, x))) for g, x in rows)


def test_bands_that_overlap(spark):
    for bad in ([("1", 0.0, 5.0, 0), ("1", 4.0, 6.0, 1)], [("1", 5.0, 5.0, 0)], [("1", None, 5.0, 0), ("1", None, 6.0, 1)]):
        with pytest.raises(ValueError, match="overlap or are empty"):
            joins.band_join(frame(spark, [("1", 1.0)], "grp string, x double"), frame(spark, bad, "group string, low double, high double, code int"), "grp", "x")
    none = frame(spark, [], "group string, low double, high double, code int")
    assert [r.level for r in joins.band_join(frame(spark, [("1", 1.0)], "grp string, x double"), none, "grp", "x").collect()] == [None]
