"""Exact duplicates by a stateful stream.

Every row enters a stream as (digest, stable identifier, content locator). A keyed state without expiry,
kept on disk by RocksDB and checkpointed in the shared folder, retains for each digest the identifier and
locator of the row that stays and the number of rows seen. When the stream has read all there is, the
state itself is the answer and is read as a table. Where the state says that a digest came more than
once, the texts behind it are compared byte by byte; should they differ, they are grouped by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.tables import materialise
from .common import ascii_lower, first_rows, fresh, whole

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Files of a store are not allocated ahead of use: there is a store for each shuffle partition.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256_digest(normal: Column) -> Column:
    return F.unhex(F.sha2(normal, 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stream_state(spark: SparkSession, ledger: str, checkpoint: str, files_per_batch: int = 1000) -> DataFrame:
    """Feed the ledger at ``ledger`` to the stream and return its state: digest, keep, group_size.

    ``keep`` is the struct (doc_id, row, locator) with the largest doc_id, null ids below all others. A
    second call with the same checkpoint reads only the files that came since and goes on from the state.
    """
    schema = spark.read.parquet(ledger).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(ledger)
    state = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row", "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    with _settings(spark, STATE_SETTINGS):
        run = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
        kept = spark.read.format("statestore").load(checkpoint)
    values = kept.schema["value"].dataType.names
    return kept.select("key.digest", F.col(f"value.{values[0]}").alias("keep"), F.col(f"value.{values[1]}").alias("group_size"))


def _mixed(normal: DataFrame, state: DataFrame) -> DataFrame:
    """Digests that came more than once and whose texts are not all the same bytes.

    The digests that came again go out as 64-bit hashes, so that they are small where copies are few; a text
    that has such a hash by chance is compared with its own copies only. Each task sends two texts a digest at most.
    """
    hits = materialise(state.filter("group_size > 1").select(F.xxhash64("digest").alias("hit")).distinct())
    suspects = normal.select("digest", "normal", F.xxhash64("digest").alias("hit")).join(hits, "hit", "left_semi")
    return suspects.groupBy("hit", "digest").agg(F.min("normal").alias("lo"), F.max("normal").alias("hi")).filter("lo <> hi").select("digest")


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest, files_per_batch: int = 1000) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest doc_id
    is kept; of rows with the same doc_id and text exactly one is. A null text counts as empty, and all
    empty texts are one group. A null doc_id is below every other; a group of null ids keeps one row with
    keep_id null. An empty table gives an empty result. Only doc_id and text are read, so other columns
    may have any name.
    """
    spark = docs.sparkSession
    normal = docs.select("doc_id", ascii_lower(whole()).alias("normal"))
    normal = normal.select("doc_id", "normal", digest(F.col("normal")).alias("digest"))
    base = shared_dir(spark)
    normal.select(
        "doc_id", "digest", F.unhex(F.sha2("normal", 256)).alias("sha"),
        F.monotonically_increasing_id().alias("row"), F.input_file_name().alias("locator"),
    ).write.parquet(f"{base}/ledger")
    ledger = spark.read.parquet(f"{base}/ledger")
    if ledger.isEmpty():
        state = spark.createDataFrame([], "digest binary, keep struct<doc_id:bigint,row:bigint,locator:string>, group_size bigint")
    else:
        state = stream_state(spark, f"{base}/ledger", f"{base}/state", files_per_batch)
    mixed = materialise(_mixed(normal, state))
    result = lambda found, sha: found.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex(sha)).alias("text_sha256"),
    )
    if mixed.isEmpty():
        return result(ledger.join(state, "digest"), "sha")
    # The bytes differ behind one digest: these rows are grouped by their bytes.
    own = materialise(normal.join(mixed, "digest", "left_semi").withColumn("row", F.monotonically_increasing_id()))
    apart = own.groupBy("normal").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    others = ledger.join(mixed, "digest", "left_anti").join(state, "digest")
    return result(others, "sha").unionByName(result(own.join(apart, "normal"), F.unhex(F.sha2("normal", 256))))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep; same columns, one row per text.

    Of rows with the same doc_id and text the one whose columns come first, compared in turn, stays.
    """
    key, sha = fresh(docs, "id_key"), fresh(docs, "sha")
    id_key = F.coalesce("doc_id", F.lit(-(2**63)))
    kept = exact_groups(docs).filter("kept").select(id_key.alias(key), F.unhex("text_sha256").alias(sha))
    marked = docs.withColumns({key: id_key, sha: F.unhex(F.sha2(ascii_lower(whole()), 256))})
    return first_rows(marked.join(kept, [key, sha], "left_semi"), [key, sha])
