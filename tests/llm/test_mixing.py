import heapq
import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortry.llm.mixing import BLOCK_ROWS, even_weights, in_mixed_order, mix, planned, schedule, segment_slots, served, shares

from .data import documents, rows


def plain_schedule(parts, slots):
    """(source, block, slot), earliest deadline first, from the first slot to the last."""
    total, waiting, ready = sum(parts), [(0, k, 0) for k in range(len(parts))], []
    for slot in range(slots):
        while waiting and waiting[0][0] <= slot:
            _, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (math.ceil(Fraction((i + 1) * total, parts[k])), k, i))
        _, k, i = heapq.heappop(ready)
        yield k, i, slot
        heapq.heappush(waiting, ((i + 1) * total // parts[k], k, i + 1))


def check(weights, slots, segment):
    """Every source stays below one block from its target weight at every slot, and blocks come in order."""
    parts = shares(weights)
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    total, names = sum(exact.values()), list(parts)
    assert names == sorted(s for s, w in exact.items() if w) and all(Fraction(a, sum(parts.values())) == exact[s] / total for s, a in parts.items())
    a, w, had = list(parts.values()), sum(parts.values()), [0] * len(names)
    at, segment = 0, segment_slots(a, segment)
    for start in range(0, slots, segment):
        assert served(a, start) == had
        for k, i, slot in schedule(a, start, min(start + segment, slots), start + segment > slots):
            assert slot == at and i == had[k]
            assert i * w // a[k] <= slot < -(-(i + 1) * w // a[k]), "within its release time and its deadline"
            at += 1
            had[k] += 1
    # Served as soon as released and before due, with blocks in order, is less than one block from the target.
    assert all(abs(n - Fraction(x * at, w)) < 1 for n, x in zip(had, a))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 30), st.floats(0.001, 100)), min_size=1, max_size=14), st.integers(1, 60))
def test_every_source_is_less_than_a_block_from_its_target(weights, segment):
    check({f"s{k:02}": w for k, w in enumerate(weights)}, 300, segment)


@pytest.mark.parametrize("weights", [
    {"hot": 0.333, "rare": 0.001, **{f"s{k}": Fraction(666, 98000) for k in range(98)}},
    {"half": 0.5, **{f"s{k}": Fraction(1, 198) for k in range(99)}}, {"a": 1, "b": 2, "c": 4}, {"a": 0.95, "b": 0.05},
])
def test_given_weights_are_met_within_a_block(weights):
    check(weights, 20_000, 1000)


@pytest.mark.parametrize("weights", [
    {"a": Fraction(1, 3), "b": Fraction(1, 7), "c": Fraction(11, 21)},
    {"hot": 10.0, **{f"s{k}": math.sqrt(k + 1) for k in range(20)}, "tiny": 1e-7, "none": 0},
])
def test_a_million_slots(weights):
    check(weights, 1_000_000, 1 << 16)


def test_wide_windows_at_a_boundary():
    # Many nearly idle sources in the middle of a block beside busy ones whose deadlines are near.
    r = random.Random(4)
    for _ in range(60):
        weights = {f"i{k:02}": Fraction(r.randint(1, 9), 10_000) for k in range(25)} | {f"b{k:02}": Fraction(r.randint(30, 60), 1000) for k in range(18)}
        check(weights, 600, r.randint(1, 40))


def test_segments_of_a_plan(spark):
    parts, blocks = {"a": 50, "b": 3, "c": 1}, {"a": 200, "b": 40, "c": 1}
    for segment in (7, 64, 100):
        got = {(r.source, r.block): r.slot for r in planned(spark, parts, blocks, segment).collect()}
        assert set(got) == {(s, i) for s, n in blocks.items() for i in range(n)} and len(set(got.values())) == len(got)
        assert all(i * 54 // parts[s] <= t < -(-(i + 1) * 54 // parts[s]) for (s, i), t in got.items())
    one = {(r.source, r.block): r.slot for r in planned(spark, parts, blocks).collect()}
    assert one == {("abc"[k], i): t for k, i, t in plain_schedule([50, 3, 1], 2000) if i < blocks["abc"[k]]}


def test_default_weights(spark):
    assert even_weights({"a": 1, "b": 2, "c": 10**12}) == {"a": 1000, "b": 1414, "c": 10**9}


def test_mix_meets_given_weights(spark):
    docs = documents(spark, *[(i, f"t{i}", None, "big" if i % 10 else "small") for i in range(400)])
    slots = [r.slot for r in mix(docs, {"big": 0.9, "small": 0.1}, block_rows=1).filter("source = 'big' AND block < 360").collect()]
    assert max(slots) < 400


def test_rows_and_order(spark):
    docs = documents(spark, *[(i, f"t{i}", None, "big" if i % 3 else "small") for i in range(300)], (None, None, None, None), (7, "again", None, "big"))
    weights = {"big": 3, "small": 1, "(none)": 0.5}
    got = mix(docs, weights, block_rows=4, cell_rows=10)
    seen = got.collect()
    assert len(seen) == docs.count()
    places = [(r.slot, r.place) for r in seen]
    assert len(set(places)) == len(places)
    for r in seen:
        assert r.release <= r.slot < r.due and 0 <= r.place < 4
    one_cell = mix(docs, weights, block_rows=4, cell_rows=10**6)
    assert rows(one_cell.filter("doc_id <> 7"), "doc_id", "slot", "place") == rows(got.filter("doc_id <> 7"), "doc_id", "slot", "place")


def test_layout_keeps_rows_and_columns(spark):
    docs = documents(spark, *[(i, f"t{i}", None, f"s{i % 4}") for i in range(50)], (3, "t3", None, "s3"))
    out = in_mixed_order(docs)
    assert out.columns == docs.columns and rows(out, *docs.columns) == rows(docs, *docs.columns)
    order = {(r.doc_id, r.source): (r.slot, r.place) for r in mix(docs).filter("doc_id <> 3").collect()}
    ids = [order[(r.doc_id, r.source)] for r in out.collect() if r.doc_id != 3]
    assert ids == sorted(ids)


def test_columns_named_like_results_are_kept(spark):
    docs = spark.createDataFrame([(i, "s", f"mine{i}", i, "b", "r", "d", "x") for i in range(40)], "doc_id long, source string, slot string, place long, block string, release string, due string, mix_cell string")
    assert rows(in_mixed_order(docs), *docs.columns) == rows(docs, *docs.columns) and in_mixed_order(docs).columns == docs.columns


def test_a_source_of_weight_zero_has_no_slot(spark):
    docs = documents(spark, *[(i, f"t{i}", None, "ab"[i % 2]) for i in range(60)])
    got = mix(docs, {"a": 1, "b": 0}).collect()
    assert {r.source: (r.slot is None, r.release is None, r.due is None) for r in got} == {"a": (False,) * 3, "b": (True,) * 3}
    assert sorted({r.slot for r in got if r.source == "a"}) == list(range(math.ceil(30 / BLOCK_ROWS)))
    assert [r.source for r in in_mixed_order(docs, {"a": 1, "b": 0}).collect()] == ["a"] * 30 + ["b"] * 30


def test_empty_and_unknown_source(spark):
    docs = documents(spark, (1, "a", None, "x"))
    assert mix(docs.limit(0)).collect() == []
    assert in_mixed_order(docs.limit(0)).collect() == []
    with pytest.raises(Exception, match="no weight for source"):
        mix(docs, {"y": 1}).collect()
