import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortry.llm import topk
from cohortry.llm.topk import search, top_k

SCHEMA = "vec_id bigint, embedding array<double>, label int, row string, block string, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "r", "b", "x") for i, v in rows], SCHEMA)


def brute(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i is not None and i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), j is None, j or 0) for m, (j, c) in enumerate(ok) if m != n)
            out += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def answer(df):
    assert dict(df.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 70), st.integers(1, 40), st.integers(1, 9), st.sampled_from([1, 3, 300]))
def test_bounds_lose_nothing(seed, rows, dims, queries, spread):
    r = np.random.default_rng(seed)
    c, q = (r.integers(-spread, spread + 1, (n, dims)).astype(float) for n in (rows, queries))
    with pytest.MonkeyPatch.context() as m:
        for name, size in (("BLOCK_DIMS", 3), ("QUERY_TILE", 4), ("ROW_TILE", 8)):
            m.setattr(topk, name, size)
        best = search(q, np.ascontiguousarray(c.T), r.integers(-1, rows, queries) * 0 - 1)
    full = q @ c.T
    for n in range(queries):
        want = np.lexsort((np.arange(rows), -full[n]))[:5]
        assert best.place[n][: len(want)].tolist() == want.tolist()
        assert best.score[n][: len(want)].tolist() == full[n][want].tolist()


def test_same_as_brute_force_over_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "LEAST_SLICE", 100)
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1) for _ in range(20)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 20) for i in range(90)]  # ties, one of them a query
    assert answer(top_k(vectors(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [1.0]), (100, []), (None, [3.0, 3.0]), (1, [3.0, 3.0]), (2, [3.0, 3.0]), (3, None),
            (150, None), (4, [1.0, None]), (200, [nan, 1.0]), (5, [inf, 9.0]), (-50, [-1.0, 0.001]), (6, [9.0, 9.0, 9.0])]
    assert answer(top_k(vectors(spark, rows))) == brute(rows)


def test_large_numbers_are_exact(spark):
    rows = [(0, [2.0**24, 2.0**18]), (1, [2.0**20, 1.0]), (2, [2.0**20, 1.0 + 1 / 256]), (3, [2.0**20, 1.0])]
    assert answer(top_k(vectors(spark, rows))) == brute(rows)
    with pytest.raises(Exception, match="64 bits"):
        top_k(vectors(spark, [(0, [1e30]), (1, [1e30])])).collect()


@pytest.mark.parametrize("rows", [[], [(50, [1.0])], [(1, [1.0]), (2, [2.0])], [(50, [1.0]), (2, [2.0])]])
def test_few_rows(spark, rows):
    assert answer(top_k(vectors(spark, rows))) == brute(rows)
