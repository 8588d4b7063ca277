import random

from cohortry.operators import patterns

from .helpers import day


def reference_sequence(entries):
    """The rule in plain Python, on (date, substance) pairs of one patient."""
    entries = sorted(entries)
    out = entries[:1] + [e for prev, e in zip(entries, entries[1:-1]) if e[1] != prev[1]]
    return out + entries[-1:] if len(entries) > 1 else out


def sequences(spark, rows):
    df = spark.createDataFrame(rows, "patid string, issuedate date, drugsubstancename string")
    return {r.patid: r for r in patterns.treatment_sequence(df).collect()}


def test_short_sequences(spark):
    d = [day(f"2011-01-0{i}") for i in range(1, 6)]
    rows = (
        [("one", d[0], "A")] + [("aaa", x, "A") for x in d[:3]] + [("aba", x, s) for x, s in zip(d, "ABA")]
        + [("abb", x, s) for x, s in zip(d, "ABB")] + [("twice_a_day", d[0], "A")] * 2
        + [("tail", d[0], "A"), ("tail", d[1], "B"), ("tail", d[1], "B"), ("tail", None, "C")]
    )
    letters = {p: "".join(r.letters) for p, r in sequences(spark, rows).items()}
    assert letters == {"one": "a", "aaa": "aa", "aba": "aba", "abb": "abb", "twice_a_day": "aa", "tail": "abb"}


def test_sequences_against_the_plain_rule(spark):
    rnd = random.Random(7)
    rows = [
        (f"p{p}", day(f"2011-01-{rnd.randint(1, 9):02d}"), rnd.choice(["Alpha", "Beta", "Gamma"]))
        for p in range(300) for _ in range(rnd.randint(1, 9))
    ]
    by_patient = {}
    for p, on, substance in rows:
        by_patient.setdefault(p, []).append((on, substance))
    got = sequences(spark, rows)
    assert set(got) == set(by_patient)
    for p, entries in by_patient.items():
        want = reference_sequence(entries)
        assert [tuple(x) for x in got[p].prescribing_pattern] == want
        assert got[p].length == len(want) and got[p].letters == [s[0].lower() for _, s in want]


def test_counts_and_top(spark):
    rows = [(f"{p}{i}", day("2011-01-01"), s) for p, s, n in (("x", "Alpha", 3), ("y", "Beta", 5), ("z", "Gamma", 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "patid string, issuedate date, drugsubstancename string")
    counts = patterns.sequence_counts(patterns.treatment_sequence(df))
    assert [(r.letters, r["count"], r.list_length) for r in patterns.top_patterns(counts, 2).collect()] == [(["b"], 5, 1), (["a"], 3, 1)]


def test_shares(spark):
    profile = spark.createDataFrame([("a", "Simvastatin"), ("b", "Atorvastatin calcium trihydrate"), ("c", "Atorvastatin calcium"), ("d", None)], "patid string, drugsubstancename string")
    rows = {r.treatment: (r["count"], round(r.percent, 3)) for r in patterns.first_treatment_share(profile).collect()}
    assert rows == {"Simvastatin": (1, 33.333), "Atorvastatin": (2, 66.667)}
    counts = patterns.classes_per_patient_hist(profile.filter("drugsubstancename IS NOT NULL").unionByName(profile.replace("Simvastatin", "X").filter("patid = 'a'")))
    assert {r.classes: (r["count"], round(r.percent, 3)) for r in counts.collect()} == {1: (2, 66.667), 2: (1, 33.333)}
