import random
from collections import Counter

import pytest

from cohortry.operators import rollup

from .helpers import codes, day


def frame(spark, rows):
    return spark.createDataFrame(rows, "PatientIdentifier string, CodeId string, EffectiveDate date, Value double")


ROWS = [
    ("a", "c1", day("2020-01-05"), 2.0), ("a", "c1", day("2020-01-01"), None), ("a", "c1", day("2020-01-05"), 2.0), ("a", "c2", day("2020-01-02"), 4.0),
    ("b", "c2", day("2020-01-03"), 5.5), ("b", "zz", day("2020-01-03"), 1.0), ("c", "c1", day("2019-12-31"), 1.0), ("d", "c1", day("2020-02-01"), 9.0),
]


def test_codes(spark):
    lists = codes(spark, "one", ("c1", "t"), ("c1", "t")).unionByName(codes(spark, "both", ("c1", "t"), ("c2", "t")))
    out = {r.PatientIdentifier: r for r in rollup.rollup_codes(frame(spark, ROWS), lists, ["one", "both"], "2020-01-01", "2020-01-31").collect()}
    assert set(out) == {"a", "b"}
    a, b = out["a"], out["b"]
    assert a["timestamps@[one]"] == [day("2020-01-01"), day("2020-01-05")] and a["[one]"] == 1
    assert a["timestamps@[both]"] == [day("2020-01-01"), day("2020-01-02"), day("2020-01-05")]
    assert (a["earliest@[both]"], a["latest@[both]"]) == (day("2020-01-01"), day("2020-01-05"))
    assert b["timestamps@[one]"] is None and b["[one]"] is None and b["latest@[one]"] is None and b["[both]"] == 1


def test_shift_moves_both_ends(spark):
    out = rollup.baseline_events(frame(spark, ROWS), "2020-01-02", "2020-02-01", 2)
    assert sorted({str(r.EffectiveDate) for r in out.collect()}) == ["2019-12-31", "2020-01-01", "2020-01-02", "2020-01-03", "2020-01-05"]


def test_values(spark):
    out = {r.PatientIdentifier: r for r in rollup.rollup_values(frame(spark, ROWS), ["c1", "c2"], "2020-01-01", "2020-01-31").collect()}
    assert (out["a"]["mean@c1"], out["a"]["max@c1"], out["a"]["min@c1"]) == (pytest.approx(5 / 3), 2.0, 1.0)
    assert out["b"]["mean@c1"] is None and out["b"]["max@c2"] == 5.5 and set(out) == {"a", "b"}


def test_timelines_are_whole(spark):
    """One patient holds a third of the rows, one day a ninth of them; some events have no date."""
    rnd = random.Random(3)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        on = day("2020-01-15") if hot and i % 9 == 0 else None if i % 50 == 1 else day(f"2020-01-{rnd.randint(1, 28):02d}")
        rows.append(("hot" if hot else f"p{rnd.randint(0, 40)}", "c1", on, rnd.choice([None, float(rnd.randint(0, 60))])))
    want = Counter((p, on, 1.0 if v is None else v) for p, _, on, v in rows)
    got = rollup.value_timeline(frame(spark, rows), ["c1"]).collect()
    assert {(r.PatientIdentifier, r.EffectiveDate, r.Value): r.copies for r in got} == want and len(got) == len(want)


def test_category_entries(spark):
    rows = [("a", "c1", day("2020-01-01"), float(i % 9)) for i in range(50)] + [("b", "c2", day("2020-01-01"), None), ("b", "zz", day("2020-01-01"), None)]
    terms = codes(spark, "l", ("c1", "White"), ("c2", "Other"), ("c2", "Other"))
    out = sorted(tuple(r) for r in rollup.category_entries(frame(spark, rows), terms).collect())
    assert out == [*(("a", f"White@{float(i)}") for i in range(9)), ("b", "Other@")]


def test_category_latest(spark):
    rows = [("a", "c1", day("2020-01-01"), None), ("a", "c2", day("2020-01-03"), None), ("a", "zz", day("2020-01-09"), None)]
    r = rollup.rollup_category(frame(spark, rows), codes(spark, "l", ("c1", "White"), ("c2", "Other")), name="ethnic").first()
    assert (r["latest@ethnic"], r["term@ethnic"]) == (day("2020-01-03"), "Other")


def test_cross_section(spark):
    people = spark.createDataFrame([("a", "1", 1, 1950, None), ("b", "0", 2, 1960, None), ("e", "1", 2, 1960, None)], "PatientIdentifier string, IsAcceptable string, Sex int, YearOfBirth int, DateOfDeath date")
    x = spark.createDataFrame([("a", 1), ("b", 2)], "PatientIdentifier string, x int")
    y = spark.createDataFrame([("e", [3])], "PatientIdentifier string, y array<int>")
    rows = {r.PatientIdentifier: (r.x, r.y, r.Sex) for r in rollup.cross_section(people, [x, y]).collect()}
    assert rows == {"a": (1, None, 1), "e": (None, [3], 2)}


def test_relevant_records(spark):
    df = frame(spark, ROWS)
    pairs = frame(spark, [("a", "c1", None, None), ("a", "c1", None, None), ("d", "c1", None, None)])
    rows = rollup.relevant_records(df, pairs, "2020-01-01", "2020-01-31")
    assert {tuple(r) for r in rows.collect()} == {ROWS[0], ROWS[1]} and rows.count() == 2
    more = rollup.relevant_records(df, pairs, "2020-01-01", "2020-01-31", frame(spark, [ROWS[0], ROWS[4]]))
    assert {tuple(r) for r in more.collect()} == {ROWS[0], ROWS[1], ROWS[4]} and more.count() == 3
