import random
import re

import numpy as np
import xxhash

from cohortry.llm import simhash
from cohortry.llm.queries import QUERIES
from cohortry.llm.simhash import drop_near_copies, fingerprint, linked, near_edges, near_groups

from ..conftest import SMALL
from .data import documents, rows


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(items):
    """Component by doc for (doc_id, fingerprint) pairs."""
    fps = sorted({f for _, f in items})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for d, f in items:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return [(d, f, least.get(find(f))) for d, f in items]


TEXTS = ["", None, "one", "one two three", "Ä B\x0bc D e f g", "a b c d " * 40_000, "\x1c x y z w v", " \t\n"]


def test_fingerprint():
    for t in TEXTS:
        assert fingerprint(t) == plain(t)


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(map(str, range(5000)))
    want = fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES", 97)
    assert fingerprint(text) == want == plain(text)


def test_trie_join_finds_every_pair(monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    monkeypatch.setattr(simhash, "SMALL_PAIR", 2)
    fps = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(8)}
    fps = np.array(sorted(fps), np.uint64)
    n = len(fps)
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 4}
    own = {tuple(sorted(p)) for a, b in linked(fps, np.array([[0, n, 0, n]])) for p in zip(a.tolist(), b.tolist())}
    assert own == want
    across = {p for a, b in linked(fps, np.array([[0, n // 2, n // 2, n]])) for p in zip(a.tolist(), b.tolist())}
    assert across == {p for p in want if p[0] < n // 2 <= p[1]}


def test_parts_of_a_large_bucket_lose_no_link(spark):
    rng = random.Random(5)
    fps = sorted({rng.getrandbits(8) << 50 | rng.getrandbits(6) for _ in range(300)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in simhash.components(near_edges(df, group_rows=20)).collect()}
    want = {d: c for d, _, c in brute([(f, f) for f in fps])}
    assert {f: roots.get(f, f) for f in fps} == want


def test_groups_and_stage(spark):
    base = " ".join(f"w{i}" for i in range(400))
    pairs = [*enumerate(TEXTS), (20, base), (21, base + " more"), (20, base), (None, base), (22, base.replace("w17 ", "W17 ")), (23, "something else entirely here"), (None, "alone one two three four")]
    docs = documents(spark, *pairs)
    want = sorted(brute([(d, plain(t)) for d, t in pairs]), key=str)
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in near_groups(docs).collect()]
    assert sorted(got, key=str) == want
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    kept = {d for d, _, c in want if d == c}
    assert rows(left, "doc_id") == [*[(d,) for d in sorted(k for k in kept if k is not None)], (None,)]
    assert near_groups(docs.limit(0)).collect() == [] and drop_near_copies(docs.limit(0)).collect() == []


def test_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = [(d, f"{f:016x}", c) for d, f, c in brute([(d, plain(t)) for d, t in texts])]
    assert rows(QUERIES["op10_simhash"](spark, SMALL), "doc_id", "fingerprint", "component_id") == sorted(want)
