"""The corpus pipeline: documents in, encoded training texts out.

Stages, each working on all that the one before kept: reject documents of poor quality, drop exact copies,
drop near copies but one of each group, lay the rest out in the order of the target mixture, encode.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.bpe import encode_texts
from cohortry.llm.exact_dedup import drop_exact_copies
from cohortry.llm.mixing import in_mixed_order
from cohortry.llm.quality import keep_good
from cohortry.llm.queries import tokenizer_path
from cohortry.llm.simhash import drop_near_copies
from cohortry.session import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_mixed_order(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """slot, place, doc_id, source, n_tokens, token_ids and the digests, in the order of the mixture.

    Files do not keep the order of the stage before, so the places are taken again: they depend on the
    ids and sources only, and are returned, so that the result keeps the mixture wherever it is stored.
    """
    placed = in_mixed_order(docs.select("doc_id", "source", "text"), places=True)
    coded = encode_texts(placed, tokenizer_path())
    return coded.select(
        "slot", "place", "doc_id", "source", F.expr("octet_length(token_ids) div 4").alias("n_tokens"), "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("exact dedup", exact), ("simhash near-dedup", near), ("mixing", mixed), ("bpe", encoded),
]
# Fingerprints and encoding can't be stated in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each result is stored in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = shared_dir(spark)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    raise AssertionError("no stages")
