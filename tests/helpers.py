"""Small literal frames."""

import datetime


def day(text):
    return None if text is None else datetime.date.fromisoformat(text)


def codes(spark, name, *pairs):
    return spark.createDataFrame([(name, str(c), t) for c, t in pairs], "list_name string, code string, term string")


def drugs(spark, *rows):
    """(patid, code, issue date, entry date, duration) with dates as day/month/year text."""
    return spark.createDataFrame(list(rows), "patid string, prodcodeid string, issuedate string, enterdate string, duration string")


def observations(spark, *rows):
    """(patid, code, event date, entry date, value, unit), all text."""
    return spark.createDataFrame(list(rows), "patid string, medcodeid string, obsdate string, enterdate string, value string, numunitid string")


def patients(spark, *rows):
    """(patid, gender, yob, mob, death, registration start, registration end, acceptable), all text."""
    return spark.createDataFrame(
        list(rows), "patid string, gender string, yob string, mob string, emis_ddate string, regstartdate string, regenddate string, acceptable string"
    )


def result(df, *names, key="patid"):
    """Rows of ``names`` by key; a single name gives bare values."""
    out = {}
    for r in df.collect():
        k = r[key]
        assert k not in out, f"{k} occurs twice"
        out[k] = r[names[0]] if len(names) == 1 else tuple(r[n] for n in names)
    return out
