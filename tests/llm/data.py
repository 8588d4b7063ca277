"""Small tables with the cases that every operator has to take."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, sha string, words string"


def documents(spark, *rows):
    """(doc_id, text[, lang[, source]]); further columns clash with names that operators use."""
    full = [(*r, *(None,) * (4 - len(r)))[:4] for r in rows]
    return spark.createDataFrame([(i, t, lang, src, len(t or ""), "k", "s", "w") for i, t, lang, src in full], SCHEMA)


def rows(df, *names):
    """The rows as tuples, in order."""
    return sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=lambda r: [(x is None, str(x)) if not isinstance(x, int) else (False, f"{x:020d}") for x in r])
