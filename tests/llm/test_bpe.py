import hashlib
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortry.llm.bpe import decode_ids, encode_texts, encoded_digests, load_automaton
from cohortry.llm.queries import QUERIES, tokenizer_path

from ..conftest import SMALL
from .data import documents

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def automaton():
    return load_automaton(PATH)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def got(automaton, text):
    ids, said = automaton.encode(text.encode())
    return [i for (i,) in struct.iter_unpack("<I", ids)], said


TEXTS = [
    "", "   ", "The QUICK brown fox's 42 jumps!!", "aaaaaaaaaaaaaaaaa", "aaaa aaa aa a", "ΟΔΟΣ Σ ΑΣ. İstanbul ǅ", "é é Ω ﬁ", "x<|endoftext|>y <|startoftext|> <|END", "日本語 한국어 🎉🎉 ½²",
    "a b c\u0085d​e", "\x1c a\x1db", "it's they'LL we'd 've", "ing" * 3000, "!" * 5000, "don't\r\n\t\x0b\x0cstop", "̀ͅ ́",
]


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library(automaton, library, text):
    assert got(automaton, text) == want(library, text)


@settings(max_examples=400, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.one_of(st.text(max_size=40), st.text("aeinrst' <|>endoftx.", max_size=60), st.text("thein ", max_size=80)))
def test_as_the_library_on_any_text(automaton, library, text):
    assert got(automaton, text) == want(library, text)


def test_full_caches_change_nothing(library, monkeypatch):
    from cohortry.llm import bpe

    for name in ("CACHED_WORDS", "CACHED_PREFIXES", "CACHED_STEPS"):
        monkeypatch.setattr(bpe, name, 3)
    small = load_automaton(PATH)
    for text in ("one two three four five one two six", "seven eight nine ten seven"):
        assert got(small, text) == want(library, text)


def test_slices_change_nothing(automaton, library, monkeypatch):
    from cohortry.llm import bpe

    monkeypatch.setattr(bpe, "SLICE", 7)
    for text in [*TEXTS, " a \n\n<|endoftext|> b<|endoftext|>c " + "word " * 50, "e \u0301e\u0301 \u023a\u0130 " * 9, "x" * 200 + " " + "x" * 200]:
        assert got(automaton, text) == want(library, text)
        assert "".join(bpe.slices(text)) == text


def test_round_trip_and_columns(spark, automaton):
    docs = documents(spark, (1, "Some words"), (None, None), (3, ""))
    coded = encode_texts(docs, PATH)
    assert coded.columns == [*docs.columns, "token_ids", "decoded"]
    again = decode_ids(coded.drop("decoded"), PATH, decoded="again")
    assert all(r.decoded == r.again for r in again.join(coded.select("n_chars", "decoded"), "n_chars").collect())
    assert encode_texts(docs.limit(0), PATH).collect() == []


def test_query_as_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op3_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, said = want(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_null_text(spark):
    (row,) = encoded_digests(documents(spark, (1, None)), PATH).collect()
    assert row.n_tokens == 0 and row.ids_sha256 == hashlib.sha256(b"").hexdigest()
