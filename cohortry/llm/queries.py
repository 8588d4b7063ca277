"""Registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoded_digests
from .chat import format_conversations, read_back, with_odd_conversation
from .collocation import collocations, collocations_sql
from .exact_dedup import exact_groups
from .language import identify
from .merkle import manifest, manifest_sql, tampered_thirds
from .mixing import mix, mix_sql
from .quality import judge, judge_sql
from .secrets import secret_digests
from .sharding import shards, shards_sql
from .simhash import near_groups
from .substrings import cut_repeats
from .topk import top_k, top_k_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the driver has the vocabulary file; a parameter of the operator."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir), tokenizer_path())


QUERIES["op3_bpe"] = op3_bpe


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir))


QUERIES["op6_exact_dedup"] = op6_exact_dedup
ORACLES["op6_exact_dedup"] = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir))


QUERIES["op2_language_id"] = op2_language_id


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir))


QUERIES["op5_secret_scan"] = op5_secret_scan


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir))


QUERIES["op1_quality_rules"] = op1_quality_rules
ORACLES["op1_quality_rules"] = judge_sql()


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir).select("doc_id", "source"))


QUERIES["op7_mixing"] = op7_mixing
ORACLES["op7_mixing"] = mix_sql()


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir))


QUERIES["op8_sharding"] = op8_sharding
ORACLES["op8_sharding"] = shards_sql()


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES["op10_simhash"] = op10_simhash


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir))


QUERIES["op4_substring_dedup"] = op4_substring_dedup


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(format_conversations(with_odd_conversation(table(spark, sf_dir, "conversations"))))


QUERIES["op9_chat_format"] = op9_chat_format


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir)
    return manifest(docs, tampered_thirds(docs))


QUERIES["op11_merkle_manifest"] = op11_merkle_manifest
ORACLES["op11_merkle_manifest"] = manifest_sql()


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


QUERIES["op12_exact_topk"] = op12_exact_topk
ORACLES["op12_exact_topk"] = top_k_sql()


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir))


QUERIES["op13_collocations"] = op13_collocations
ORACLES["op13_collocations"] = collocations_sql()
