"""Unions, differences, distinct keys, sorting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_lists(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all batches, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def except_keys(keys: DataFrame, found: DataFrame, key: str = "patid") -> DataFrame:
    """Distinct keys of the first frame that the second lacks."""
    return keys.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")


def diff_frames(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either frame that the other lacks, copies counted; empty when both are equal."""
    right = right.select(*left.columns)
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(
        right.exceptAll(left).withColumn("side", F.lit("right"))
    )


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the remaining columns, so that the choice never varies."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    chosen = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    return chosen.select(*keys, "row.*").select(*df.columns)


def order_by(df: DataFrame, *columns: str, ascending: bool = False) -> DataFrame:
    return df.orderBy(*columns, ascending=ascending)


def diff_frames_by_hash(a: DataFrame, b: DataFrame, buckets: int = 4096) -> DataFrame:
    """``diff_frames``, with buckets of equal rows left out first.

    Each side is reduced to a fingerprint for every hash bucket (its rows, and the sum of their second
    hashes, so repeated rows count). Only rows of buckets whose fingerprints differ are shuffled and
    compared in full; two equal frames cost one small aggregate each. Fingerprints that agree by chance
    would hide a difference with a probability of about 2 ** -64 a bucket.
    """
    names = a.columns
    # Hashes pass over nulls, so where they stand is hashed too.
    fields = [x for c in names for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]

    def marked(df: DataFrame) -> DataFrame:
        return df.select(*names, F.pmod(F.xxhash64(*fields), F.lit(buckets)).alias("_bucket"))

    def prints(df: DataFrame) -> DataFrame:
        second = F.xxhash64(F.lit(1), *fields).cast("decimal(38,0)")
        return marked(df).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"), F.sum(second).alias("_sum"))

    p, q = prints(a).alias("p"), prints(b).alias("q")
    same = F.col("p._n").eqNullSafe(F.col("q._n")) & F.col("p._sum").eqNullSafe(F.col("q._sum"))
    differ = p.join(q, F.col("p._bucket") == F.col("q._bucket"), "full").filter(~same).select(F.coalesce("p._bucket", "q._bucket").alias("_bucket"))
    # A row for each bucket at most.
    left, right = (marked(df).join(F.broadcast(differ), "_bucket", "left_semi").drop("_bucket") for df in (a, b))
    return diff_frames(left, right)
