import hashlib
import struct

from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from cohortry.llm.mixing import BLOCK_ROWS, even_weights, mix
from cohortry.llm.quality import judge
from cohortry.llm.queries import tokenizer_path

from ..conftest import SMALL
from .data import documents
from .test_mixing import plain_schedule
from .test_simhash import brute, plain


def test_run_as_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    good = {r.doc_id for r in judge(docs).filter("kept").collect()}  # compared with SQL elsewhere
    by_text = {}
    for d in sorted(good):
        by_text[texts[d][0].encode().lower()] = d
    kept = {d for d, _, c in brute([(d, plain(texts[d][0])) for d in by_text.values()]) if d == c}
    assert 0 < len(kept) < len(by_text) <= len(good) < len(texts)
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in out} == kept and len(out) == len(kept)
    order = {r.doc_id: (r.slot, r.place) for r in mix(docs.filter(docs.doc_id.isin(sorted(kept)))).collect()}
    places = [order[r.doc_id] for r in out]
    assert sorted(places) == sorted(order.values())
    library = Tokenizer.from_file(tokenizer_path())
    for r in out:
        ids = library.encode(texts[r.doc_id][0], add_special_tokens=False).ids
        assert bytes(r.token_ids) == struct.pack(f"<{len(ids)}I", *ids) and r.n_tokens == len(ids) and r.source == texts[r.doc_id][1]
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_keep_the_columns_and_take_odd_tables(spark):
    text = " ".join(f"word{i} and text" for i in range(60))
    odd = documents(spark, (None, None), (1, text, "en", "a"), (1, text, "en", "a"), (2, text, None, None), (3, "", "en", "a"), (None, text + " other", None, "b"))
    for docs in (odd, odd.limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            out.collect()


def test_places_of_the_mixture_are_in_the_result(spark, tmp_path):
    sources = ("a",) * 6 + ("b",) * 2 + ("c",)
    docs = documents(spark, *[(i, f"text {i}", None, sources[i % 9]) for i in range(400)])
    of = {}
    for i in range(400):
        of.setdefault(sources[i % 9], []).append(i)
    names = sorted(of)
    weights = even_weights({s: len(ids) for s, ids in of.items()})
    at = {(names[k], i): slot for k, i, slot in plain_schedule([weights[s] for s in names], 2000)}
    want = {}
    for s, ids in of.items():
        for r, i in enumerate(sorted(ids, key=lambda i: hashlib.md5(str(i).encode()).hexdigest())):
            want[i] = (at[s, r // BLOCK_ROWS], r % BLOCK_ROWS)
    # Read again from several files, the largest of which is not the first.
    corpus_pipeline.mixed(spark, docs, SMALL).filter("doc_id < 40 OR doc_id > 60").coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs.filter("doc_id BETWEEN 40 AND 60").write.mode("append").parquet(f"{tmp_path}/docs")
    out = corpus_pipeline.encoded(spark, spark.read.parquet(f"{tmp_path}/docs"), SMALL)
    assert [(r.slot, r.place) for r in out.collect()] == sorted(want.values())
    out.repartition(3).write.parquet(f"{tmp_path}/out")
    assert {r.doc_id: (r.slot, r.place) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want


def test_registered():
    assert "pipeline" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.oracle_sql()
