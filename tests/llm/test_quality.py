import re

import pytest

from cohortry.llm import quality
from cohortry.llm.quality import COUNTS, RULES, fit, judge, keep_good, votes, with_counts

from .data import documents, rows

GOOD = "\n".join(f"Some plain words line {i} with other tokens {i * 7} here and there." for i in range(12))
TEXTS = [GOOD, None, "", "a b c a b c", "x " * 60, GOOD + "\n" + GOOD, "# $ % word " * 30, "É x\x0b\x0cy  z\n\n \nz\nz", "word " * 100_000, "#" * 200_000]


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    where = {}
    for i in range(len(words) - 2):
        where.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + o for at in where.values() if len(at) > 1 for i in at for o in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts(spark):
    docs = documents(spark, *enumerate(TEXTS), (0, GOOD))
    got = rows(judge(docs), "doc_id", *COUNTS, "base_failed", "kept")
    want = sorted([*enumerate(TEXTS), (0, GOOD)], key=lambda r: r[0])
    assert [g[:6] for g in got] == [(i, *plain(t)) for i, t in want]
    for _, n, _, _, _, repeated, failed, kept in got:
        assert failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (failed and kept)
    assert judge(docs.limit(0)).collect() == []


def test_estimation_trusts_rules_that_agree(spark):
    n = len(RULES)
    say = [([1] * n, 800), ([-1] * (n - 1) + [1], 150), ([1] * (n - 1) + [-1], 50), ([0] * n, 5)]
    voted = spark.createDataFrame([(v,) for v, k in say for _ in range(k)], "votes array<int>")
    chance = {tuple(r.votes): r.posterior for r in fit(voted).collect()}
    assert chance[(1,) * n] > 0.99 and chance[(-1,) * (n - 1) + (1,)] < 0.01
    assert chance[(1,) * (n - 1) + (-1,)] > 0.9, "one rule alone does not reject"
    assert 0.5 < chance[(0,) * n] < 1


def test_stage_keeps_columns_and_agrees_with_the_verdict(spark):
    docs = documents(spark, *enumerate(TEXTS), (None, GOOD))
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == rows(judge(docs).filter("kept"), "doc_id")
    assert votes("c") is not None and with_counts(docs, "counts").columns[-1] == "counts"


@pytest.mark.parametrize("slice_chars", [3, 40, 1 << 16])
def test_sliced_texts_are_counted_alike(spark, monkeypatch, slice_chars):
    monkeypatch.setattr(quality, "LONG_BYTES", 20)
    monkeypatch.setattr(quality, "SLICE_CHARS", slice_chars)
    texts = [*TEXTS[:8], "word " * 400, "#" * 3000, " \n" * 50 + "one", "\nx y\n\n" + "a b c\n" * 9 + "tail " + " " * 99, GOOD.replace(" ", "\n")]
    docs = documents(spark, *enumerate(texts), (0, GOOD))
    got = rows(judge(docs), "doc_id", *COUNTS)
    assert got == [(i, *plain(t)) for i, t in sorted([*enumerate(texts), (0, GOOD)], key=lambda r: r[0])]
    assert rows(keep_good(docs), *docs.columns) == rows(docs.join(judge(docs).filter("kept").select("doc_id").distinct(), "doc_id"), *docs.columns)
