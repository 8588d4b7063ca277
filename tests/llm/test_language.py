import math
import zlib
from collections import Counter

import pytest

from cohortry.llm import language
from cohortry.llm.language import identify, predict, train
from cohortry.llm.queries import QUERIES

from ..conftest import SMALL
from .data import documents

LONG = "the thing is that there " * 20_000


def test_cases(spark):
    docs = documents(spark, (1, "the thing and the other", "en"), (2, "le chat et la souris", "fr"), (3, "le la les", "fr"), (4, "the the of", "en"), (None, "zzz", "xx"),
                     (5, None, "en"), (6, "123 !!", "fr"), (7, "", None), (8, LONG, None), (8, "le chat", None))
    got = [(r.doc_id, r.lang_pred, 0 <= r.score <= 1) for r in identify(docs).collect()]
    assert sorted(g for g in got if g[0] in (5, 6, 7, 8)) == [(5, "und", True), (6, "und", True), (7, "und", True), (8, "en", True), (8, "fr", True)]
    assert "xx" not in {g[1] for g in got} and len(got) == docs.count()
    assert identify(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in identify(docs.withColumn("lang", docs.lang.substr(9, 1)).filter("false").unionByName(docs.filter("lang is null"))).collect()} == {"und"}


def test_segments_change_nothing(spark, monkeypatch):
    docs = documents(spark, (1, LONG[:5000], "en"), (2, "çà été où " * 300, "fr"), (4, "abc " * 200, "en"))
    texts = [r.text for r in docs.collect()]
    once = [(int(b), int(r)) for bs, rs in language.bundles(texts) for b, r in zip(bs, rs)]
    monkeypatch.setattr(language, "SEGMENT", 64)
    assert sorted(once) == sorted((int(b), int(r)) for bs, rs in language.bundles(texts) for b, r in zip(bs, rs))


def test_labels_of_the_fold_are_not_used(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, logs = train(docs)
    wrong = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 4 = 2 then 'q' else lang end lang")
    again, other = train(wrong)
    assert names == again and (logs == other).all()
    assert predict(docs.select("doc_id", "text"), (names, logs)).count() == docs.count()


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op2_language_id"](spark, SMALL).collect() if r.held_out]
    assert {r.doc_id for r in rows} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in rows) / len(rows) >= 0.95


def _plain_buckets(text):
    """Buckets of the bigrams and trigrams with a letter, one n-gram at a time."""
    points = [0, 0, *[ord(c) if c.isalpha() else 0 for c in (text or "").lower()], 0, 0]
    out = Counter()
    for a, b, c in zip(points, points[1:], points[2:]):
        for n, x in ((a or b, a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F), (a or b or c, a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + c * 0x165667B19E3779F9 + 1)):
            if n:
                x %= 2**64
                x = ((x ^ x >> 29) * 0xBF58476D1CE4E5B9) % 2**64
                out[x >> 64 - language.BUCKET_BITS] += 1
    return out


def test_same_as_plain_naive_bayes(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    counts, prior = {}, Counter()
    for i, (text, lang) in found.items():
        if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            counts.setdefault(lang, Counter()).update(_plain_buckets(text))
            prior[lang] += 1
    size = {lang: sum(c.values()) + language.SMOOTHING * 2**language.BUCKET_BITS for lang, c in counts.items()}
    log = {lang: math.log(n / prior.total()) for lang, n in prior.items()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs).collect()}
    for i, (text, _) in found.items():
        own = _plain_buckets(text)
        if not own:
            assert got[i] == ("und", 0)
            continue
        total = {lang: log[lang] + sum(n * math.log((c[b] + language.SMOOTHING) / size[lang]) for b, n in own.items()) for lang, c in counts.items()}
        best = max(sorted(total), key=total.get)
        assert got[i][0] == best and got[i][1] == pytest.approx(1 / sum(math.exp(t - total[best]) for t in total.values()), abs=1e-3)
