import hashlib
import random

import pytest

from cohortry.llm import substrings
from cohortry.llm.queries import QUERIES
from cohortry.llm.substrings import cut_repeats

from ..conftest import SMALL
from .data import documents, rows


def brute(items, window=13):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in items]
    for d, w in split:
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        left = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


NAMES = ("doc_id", "n_words", "n_removed", "kept_sha256")


def same(spark, items):
    got = [tuple(r[n] for n in NAMES) for r in cut_repeats(documents(spark, *items)).collect()]
    assert sorted(got, key=str) == brute(items)


@pytest.fixture(params=[substrings.PIECE, 300])
def piece(request, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", request.param)


def test_random_texts(spark, piece):
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    items = []
    for d in range(60):
        words = [rng.choice("abc") + str(rng.randint(0, 40)) for _ in range(rng.randint(0, 80))]
        a = rng.randint(0, 50)
        words[len(words) // 2 : len(words) // 2] = passage[a : a + rng.randint(0, 30)]
        items.append((d, rng.choice([" ", "\n", " \t "]).join(words)))
    rng.shuffle(items)
    same(spark, items)


def test_cases(spark, piece):
    t = " ".join(f"w{i}" for i in range(30))
    same(spark, [(5, t), (3, t), (9, t + "  end"), (3, t), (7, None), (8, ""), (None, t), (11, " ".join(f"w{i}" for i in range(12))), (12, "É " * 40), (13, "É " * 13), (5, "other " + t),
                 (20, "long " * 3000), (21, "x " + "long " * 3000)])


def test_empty(spark):
    assert cut_repeats(documents(spark, (1, "a")).limit(0)).collect() == []


def test_query(spark):
    items = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = rows(QUERIES["op4_substring_dedup"](spark, SMALL), *NAMES)
    assert sorted(got, key=str) == brute(items) and any(r[2] for r in got)
