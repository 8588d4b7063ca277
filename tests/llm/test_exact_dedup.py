from pyspark.sql import functions as F

from cohortry.llm.exact_dedup import drop_exact_copies, exact_groups, stream_state
from cohortry.llm.language import identify
from cohortry.llm.simhash import drop_near_copies, near_groups
from cohortry.llm.substrings import cut_repeats

from .data import documents, rows

CASES = [(1, "Abc"), (2, "abc"), (2, "abc"), (None, None), (3, ""), (4, "É"), (5, "é"), (None, "q"), (6, "long " * 50_000), (7, "LONG " * 50_000)]
WANT = [(1, 2, 3, False), (2, 2, 3, False), (2, 2, 3, True), (3, 3, 2, True), (4, 4, 1, True), (5, 5, 1, True), (6, 7, 2, False), (7, 7, 2, True),
        (None, 3, 2, False), (None, None, 1, True)]


def test_groups(spark):
    assert rows(exact_groups(documents(spark, *CASES)), "doc_id", "keep_id", "group_size", "kept") == WANT


def test_texts_behind_one_digest_are_told_apart(spark):
    got = exact_groups(documents(spark, *CASES), digest=lambda normal: F.unhex(F.lit("00")) if normal is not None else normal)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept") == WANT


def test_one_digest_and_one_hash_for_all(spark, monkeypatch):
    real = F.sha2
    monkeypatch.setattr(F, "sha2", lambda c, n: F.substring(real(c, n), 1, 1))
    got = exact_groups(documents(spark, *CASES))
    assert rows(got, "doc_id", "keep_id", "group_size", "kept") == WANT


def test_the_row_that_stays_does_not_depend_on_partitions(spark):
    docs = documents(spark, *[(1, "same", None, s) for s in "dbcae"], (2, None, None, "y"), (2, None, None, "x"))
    for stage in (drop_exact_copies, drop_near_copies):
        assert {tuple(sorted((r.doc_id, r.source) for r in stage(docs.repartition(n)).collect())) for n in (1, 3, 7)} == {((1, "a"), (2, "x"))}


def test_narrow_ids(spark):
    docs = documents(spark, *[c for c in CASES if c[0] is not None])
    narrow = docs.withColumn("doc_id", docs.doc_id.cast("int"))
    for f in (lambda d: identify(d).drop("score"), cut_repeats, lambda d: near_groups(d).select("doc_id", "fp", "component_id"), exact_groups):
        assert sorted(map(str, f(narrow).collect())) == sorted(map(str, f(docs).collect()))


def test_stage_keeps_columns_and_one_row_of_each_text(spark):
    docs = documents(spark, *CASES)
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert rows(left, "doc_id") == [(2,), (3,), (4,), (5,), (7,), (None,)]


def test_empty_table(spark):
    assert exact_groups(documents(spark, *CASES).limit(0)).collect() == []


def test_state_goes_on_from_its_checkpoint(spark, tmp_path):
    ledger, state = f"{tmp_path}/ledger", f"{tmp_path}/state"

    def add(*pairs):
        spark.createDataFrame([(i, bytearray(d.encode()), i, "f") for i, d in pairs], "doc_id bigint, digest binary, row bigint, locator string").write.mode("append").parquet(ledger)
        return {bytes(r.digest).decode(): (r.keep.doc_id, r.group_size) for r in stream_state(spark, ledger, state, files_per_batch=2).collect()}

    assert add((1, "a"), (5, "a"), (2, "b")) == {"a": (5, 2), "b": (2, 1)}
    assert add((3, "a"), (9, "b"), (4, "c")) == {"a": (5, 3), "b": (9, 2), "c": (4, 1)}
