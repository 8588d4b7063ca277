import hashlib
import zlib

import pytest

from cohortry.llm import merkle
from cohortry.llm.merkle import manifest, tampered_thirds

from .data import SCHEMA, documents


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(doc_id, source, lang, n_chars, text):
    return _h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def _tree(nodes):
    """The root, and for each leaf the runs it climbs through: (digests of a run, place in it)."""
    paths = [[] for _ in nodes]
    own, level = list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, p in enumerate(own):
            run = level[p // 8 * 8 : p // 8 * 8 + 8]
            paths[k].append((run, p % 8))
            own[k] = p // 8
        level = [_h(*level[i : i + 8]) for i in range(0, len(level), 8)]
    return level[0], paths


def brute(found):
    """The rows of ``manifest`` for (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in found}, key=lambda x: (x is not None, (x or "").encode()))
    trees, roots = {}, []
    for lang in langs:
        own = sorted((r for r in found if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
        trees[lang] = own, *_tree([_leaf(*r) for r in own])
        roots.append(trees[lang][1])
    root, tops = _tree(roots)
    out = []
    for lang, top in zip(langs, tops):
        own, subroot, paths = trees[lang]
        for r, path in zip(own, paths):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded, proof = _leaf(*r[:4], text), []
            for run, at in path + top:
                proof += run[:at] + run[at + 1 :]
                folded = _h(*run[:at], folded, *run[at + 1 :])
            out.append((r[0], _leaf(*r), subroot, root, _h(*proof), folded, folded == root))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def answer(df):
    assert df.columns == list(COLUMNS)
    return sorted((tuple(r) for r in df.collect()), key=str)


def fields(docs):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]


@pytest.mark.parametrize("block_levels", [1, 4])
def test_same_as_brute_force(spark, monkeypatch, block_levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(merkle, "CLIMB", merkle.CLIMB.replace("shiftright(pos, 12)", f"shiftright(pos, {3 * block_levels})"))
    odd = [(None, None, None, None), (None, "x", "en", None), (7, "Again", "de", "s"), (7, "Again", "de", "s"), (7, "other", "de", "s"), (9, "", "", ""), (10, "ÄÖ A" * 3000, "fr", "ü")]
    docs = documents(spark, *[(i, f"Text {i}", ("en", "de", "es", None)[i * i % 7 % 4], f"s{i % 3}") for i in range(20, 720)], *odd)
    assert answer(manifest(docs, tampered_thirds(docs))) == brute(fields(docs))


def test_many_languages(spark):
    docs = documents(spark, *[(i, f"T {i}", f"l{i % 70}", None) for i in range(150)])
    got = answer(manifest(docs, tampered_thirds(docs)))
    assert got == brute(fields(docs)) and {r[-1] for r in got} == {True, False}


def test_untouched_rows_verify(spark):
    docs = documents(spark, *[(i, "Same text", "en", None) for i in range(65)])
    assert {r[-1] for r in answer(manifest(docs))} == {True}


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small_tables(spark, n):
    docs = spark.createDataFrame([(i, "A", "en", "s", 1, "k", "s", "w") for i in range(n)], SCHEMA)
    assert answer(manifest(docs, tampered_thirds(docs))) == (brute(fields(docs)) if n else [])
