"""Stored tables: reading, writing, layout, text export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sets import union_lists
from ..session import shared_dir

# The columns of each table that the analyses rely on, as read from an extract.
CONTRACTS = {
    "drug_issue": (
        "patid", "pracid", "drugrecid", "issuedate", "enterdate", "prodcodeid", "dosageid", "quantity",
        "quantunitid", "duration",
    ),
    "observation": ("patid", "pracid", "obsid", "obsdate", "enterdate", "medcodeid", "value", "numunitid"),
    "patient": ("patid", "gender", "yob", "mob", "emis_ddate", "regstartdate", "regenddate", "acceptable"),
    "practice": ("pracid", "lcd", "uts", "region"),
}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.format(fmt).load(path)
    return df if columns is None else df.select(*columns)


def read_batches(spark: SparkSession, paths: Sequence[str], table: str, fmt: str = "parquet") -> DataFrame:
    """All batches of one table, each cut to the table's columns, as one frame."""
    return union_lists([read_table(spark, p, fmt, CONTRACTS[table]) for p in paths])


def write_table(df: DataFrame, path: str, save: bool = True, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Overwrite ``path`` and return what is stored there; with ``save`` off nothing is written."""
    if not save:
        return df
    writer = df.write.mode("overwrite").format(fmt)
    if merge_schema:
        if fmt != "delta":
            raise ValueError(f"schemas can't be merged on writing {fmt}")
        writer = writer.option("mergeSchema", "true")
    writer.save(path)
    return df.sparkSession.read.format(fmt).load(path)


def materialise(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder and read back, for a result that several later steps use.

    The work behind it is done once, and is not repeated when an executor is lost.
    """
    return write_table(df, shared_dir(df.sparkSession))


def cluster_layout(
    spark: SparkSession, source: str, path: str, keys: Sequence[str] = ("patid",), partitions: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Rewrite a stored table in ranges of the keys, so that min/max statistics skip files and row groups.

    The row number within the scan ends the order, so a key, or a group of equal rows, that holds a
    large share of the table is spread over several files. Numbers taken straight from a scan of
    stored files are the same on every attempt of a task.
    """
    order = [F.col(c) for c in [*keys, "_row"]]
    rows = read_table(spark, source, fmt).withColumn("_row", F.monotonically_increasing_id())
    spread = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    return write_table(spread.sortWithinPartitions(*order).drop("_row"), path, fmt=fmt)


def flatten_arrays_for_csv(df: DataFrame, sep: str = ",") -> DataFrame:
    """Every array column as text joined by ``sep``; other columns unchanged."""
    arrays = {f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
    return df.select(*[
        F.concat_ws(sep, F.col(f"`{c}`").cast("array<string>")).alias(c) if c in arrays else F.col(f"`{c}`")
        for c in df.columns
    ])


def export_delimited(df: DataFrame, path: str, sep: str = ",", single_file: bool = False) -> str:
    """Header text files, written in parallel; with ``single_file`` one task writes one file, for results
    that are to be read by hand."""
    flat = flatten_arrays_for_csv(df)
    if single_file:
        flat = flat.coalesce(1)
    flat.write.mode("overwrite").csv(path, sep=sep, header=True)
    return path
