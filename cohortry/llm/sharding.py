"""Shards of bounded size by extendible hashing.

Rows hash to 60 bits. The directory starts with one bucket; a bucket over the byte limit, and only such a
one, splits on the next bit, until each fits. All is DataFrame work: sizes by hash prefix are one
aggregate for several depths at once, over the rows of buckets that are still too large.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .common import whole

HASH_BITS, DEPTHS_A_ROUND = 60, 8
LIMIT_BYTES = 1 << 20


def _prefix(hashed: str, depth: str) -> F.Column:
    return F.expr(f"shiftright({hashed}, cast({HASH_BITS} - {depth} AS int))")


def directory(sized: DataFrame, limit: int, depths: int = DEPTHS_A_ROUND) -> DataFrame:
    """Buckets (depth, prefix, shard_bytes, shard_rows, fits) for rows of (h, bytes)."""
    found, still, depth = [], sized.select("h", "bytes"), 0
    while True:
        last = min(depth + depths - 1, HASH_BITS)
        levels = still.select(F.explode(F.sequence(F.lit(depth), F.lit(last))).alias("depth"), "h", "bytes").select("depth", _prefix("h", "depth").alias("prefix"), "h", "bytes")
        sizes = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"), (F.min("h") == F.max("h")).alias("single"))
        sizes = materialise(sizes.withColumn("fits", F.col("shard_bytes") <= limit))
        full = sizes.filter("NOT fits AND NOT single")
        parents = full.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        done = sizes.filter("fits OR single")
        split = done.withColumn("parent", F.expr("shiftright(prefix, 1)")).join(parents, ["depth", "parent"], "left_semi")
        found += [done.filter(F.col("depth") == depth).drop("single"), split.filter(F.col("depth") > depth).select(*[c for c in done.columns if c != "single"])]
        over = full.filter(F.col("depth") == last).select("prefix")
        if last == HASH_BITS or over.isEmpty():
            return reduce(DataFrame.unionByName, found)
        still = still.withColumn("prefix", F.expr(f"shiftright(h, {HASH_BITS - last})")).join(over, "prefix", "left_semi").select("h", "bytes")
        depth = last + 1


def shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, bytes, shard (the bits of its bucket, empty for the only one), depth, shard_bytes, shard_rows, fits.

    A row's bytes are those of its text in UTF-8; a null text has none. The hash is of id and text, so a
    repeated id can be split; rows equal in both can't, and a bucket of nothing else, or of one text over
    the limit, is left as it is with ``fits`` false. An empty table gives no rows. Only doc_id and text are
    read.
    """
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(whole()))
    sized = materialise(docs.select("doc_id", F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long").alias("h"), F.octet_length(whole()).cast("long").alias("bytes")))
    buckets = materialise(directory(sized, limit))
    depths = [r["depth"] for r in buckets.select("depth").distinct().collect()]  # at most one for each bit
    tried = sized.withColumn("depth", F.explode(F.array(*map(F.lit, depths)) if depths else F.expr("CAST(array() AS array<int>)")))
    placed = tried.withColumn("prefix", _prefix("h", "depth")).join(buckets, ["depth", "prefix"])
    bits = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    return placed.select("doc_id", "bytes", bits.alias("shard"), F.col("depth").cast("long").alias("depth"), "shard_bytes", "shard_rows", "fits")


def shards_sql(limit: int = LIMIT_BYTES) -> str:
    """``shards`` as DuckDB SQL: of all depths, the least at which the row's bucket is done."""
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, strlen(coalesce(text, '')) AS bytes,
         ('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT AS h FROM documents),
l AS (SELECT d.*, depth, h >> ({HASH_BITS} - depth) AS prefix FROM d, range(0, {HASH_BITS} + 1) AS r(depth)),
s AS (SELECT depth, prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows, min(h) = max(h) AS single FROM l GROUP BY ALL),
f AS (SELECT rid, l.doc_id, l.bytes, l.depth, prefix, shard_bytes, shard_rows FROM l JOIN s USING (depth, prefix)
      WHERE shard_bytes <= {limit} OR single QUALIFY row_number() OVER (PARTITION BY rid ORDER BY depth) = 1)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INT, '0') END AS shard, depth, shard_bytes, shard_rows, shard_bytes <= {limit} AS fits FROM f"""
