import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortry.llm import collocation
from cohortry.llm.collocation import U64, collocations, half_bits, load_filter, member, pack, permute, restore, store_filter, summed, unpack

from .data import documents


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([2, 3, 4]), st.sampled_from([2, 8, 18, 22, 32]), st.integers(0, 400), st.integers(0, 3))
def test_a_filter_loses_nothing(seed, n, bits, rows, part_bits):
    r = np.random.default_rng(seed)
    words = r.integers(0, min(1 << bits, 9 if seed % 2 else 1 << bits), (rows, n))
    half = half_bits(n, bits)
    part_bits = min(part_bits, half)
    hi, lo = permute(*pack(words, bits), half)
    weight = r.choice([1, 2, 254, 255, 256, 10**12], rows).astype(np.int64)
    hi, lo, counts = summed(hi, lo, weight, half)
    got = Counter()
    for part in range(1 << part_bits):
        own = (hi >> U64(half - part_bits)) == U64(part) if part_bits else np.ones(len(hi), bool)
        back = load_filter(store_filter(hi[own], lo[own], counts[own], half, part_bits, part))
        for row, c in zip(unpack(*restore(back[0], back[1], half), n, bits).tolist(), back[2].tolist()):
            got[tuple(row)] += c
    want = Counter()
    for row, c in zip(words.tolist(), weight.tolist()):
        want[tuple(row)] += c
    assert got == want
    if rows:
        assert member(hi, lo, hi[::2], lo[::2], half).tolist() == [k % 2 == 0 for k in range(len(hi))]


def brute(found, least, top=2000):
    f, total = Counter(), Counter()
    for text, lang in found:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            f.update((lang, *w[i : i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    f = {g: c for g, c in f.items() if c >= least}
    rows = []
    for (lang, *w), a in f.items():
        if len(w) < 2:
            continue
        inside = [c for (other, *v), c in f.items() if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if any(100 * c >= 80 * a for c in inside):
            continue
        score, _, left, right = min((2_000_000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        rows.append((lang, " ".join(w), a, left, right, total[lang], score))
    out = []
    for lang in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, k, *r[1:]) for k, r in enumerate(own[:top], 1)]
    return sorted(out)


def answer(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in df.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("shard_words,part_entries", [(1 << 20, 1 << 21), (60, 8)])
def test_same_as_brute_force(spark, monkeypatch, shard_words, part_entries):
    monkeypatch.setattr(collocation, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(collocation, "OPEN_WORDS", 3 * shard_words)
    monkeypatch.setattr(collocation, "PART_ENTRIES", part_entries)
    r = random.Random(5)
    vocabulary = ["the", "The", "of", "naïve", "été", "x y", "a\x1cb", "\x00", "red", "fox", "über", "日本"]
    texts = [("".join(r.choice(vocabulary) + r.choice([" ", " ", " ", "\t ", ". ", "\n", ", ", "!?"]) for _ in range(r.randrange(80))), r.choice(["en", "de", None, "und"])) for _ in range(120)]
    texts += [("the quick brown fox. " * 400, "en"), (None, "en"), ("", None), (". , \t", "fr"), ("alone", "fr")]
    docs = documents(spark, *[(k, t, lang) for k, (t, lang) in enumerate(texts)])
    for least, top in ((6, 2000), (3, 7)):
        want = brute(texts, least, top)
        assert want and answer(collocations(docs, least, top)) == want


def test_no_rows(spark):
    docs = documents(spark, (1, "one two three", "en"), (2, None, None))
    assert answer(collocations(docs)) == [] == answer(collocations(docs.limit(0)))
