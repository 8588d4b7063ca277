"""Raw extracts: tab-separated text described by an XML schema, with a log of record counts."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COLUMN = T.StructType([
    T.StructField("displayname", T.StringType()),
    T.StructField("header", T.StringType()),
    T.StructField("columnposition", T.IntegerType()),
])
_ITEM = T.StructType([T.StructField("timestamp", T.StringType()), T.StructField("text", T.StringType())])
_SECTION = T.StructType([T.StructField("title", T.StringType()), T.StructField("item", T.ArrayType(_ITEM))])


def schema_from_xml(spark: SparkSession, path: str) -> DataFrame:
    """(displayname, header, columnposition), one row per column of the extract."""
    return spark.read.format("xml").option("rowTag", "datacolumn").schema(_COLUMN).load(path)


def extract_schema(spark: SparkSession, path: str) -> T.StructType:
    """All-text schema in column order, from one row per column of the extract."""
    rows = schema_from_xml(spark, path).orderBy("columnposition").collect()
    if not rows:
        raise ValueError(f"{path} describes no columns")
    return T.StructType([T.StructField(r.header, T.StringType()) for r in rows])


def read_extract(spark: SparkSession, path: str, schema_path: str | None = None, sep: str = "\t") -> DataFrame:
    """Every text file of the folder. Without a schema file, or with one that can't be read, the header names
    the columns, all text. A header in another order than the schema is an error."""
    reader = spark.read.option("header", True).option("sep", sep).option("pathGlobFilter", "*.txt")
    if schema_path is not None:
        try:
            reader = reader.schema(extract_schema(spark, schema_path)).option("enforceSchema", False)
        except (AnalysisException, ValueError) as problem:
            warnings.warn(f"no schema, the header is used: {problem}", stacklevel=2)
    return reader.csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    """Header CSV with a stated schema, so that no pass is spent on inference; bad cells become null."""
    return spark.read.csv(path, schema=schema, header=True, sep=sep, mode="PERMISSIVE")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(section_title, timestamp, text), one row per item of the log."""
    sections = spark.read.format("xml").option("rowTag", "section").schema(_SECTION).load(path)
    return sections.select(F.col("title").alias("section_title"), F.explode("item").alias("item")).select(
        "section_title", "item.timestamp", "item.text"
    )


def read_log_counts(spark: SparkSession, path: str) -> DataFrame:
    """(section, expected): the number before ``records retrieved`` in each section."""
    found = F.regexp_extract("text", r"(\d+)\s*records retrieved", 1).try_cast("bigint")
    return (
        read_log(spark, path).select(F.col("section_title").alias("section"), found.alias("expected"))
        .filter(F.col("expected").isNotNull()).groupBy("section").agg(F.max("expected").alias("expected"))
    )


def check_count(expected: DataFrame, tables: Mapping[str, DataFrame], strict: bool = False) -> DataFrame:
    """(section, expected, found, ok) for each named table; ``strict`` raises on the first that differs."""
    found = None
    for section, table in tables.items():
        one = table.agg(F.count(F.lit(1)).alias("found")).select(F.lit(section).alias("section"), "found")
        found = one if found is None else found.unionByName(one)
    out = expected.join(found, "section", "right").select(
        "section", "expected", "found", F.col("expected").eqNullSafe(F.col("found")).alias("ok")
    )
    if strict:
        bad = out.filter(~F.col("ok")).first()
        if bad is not None:
            raise ValueError(f"{bad.section}: expected {bad.expected} records, found {bad.found}")
    return out


def check_files(spark: SparkSession, path: str, columns: int, sep: str = "\t") -> DataFrame:
    """(file, records, header, bad_records, checksum) of every text file of the folder, from one scan.

    ``records`` are the lines after the first, ``bad_records`` those with another number of fields than
    ``columns``. The checksum is the sum of the first eight hex digits of each record's MD5, so it does not
    depend on the order, and a repeated or missing record shows. Files without a line are not listed.
    """
    lines = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Each part of a split file keeps its first line; the header is that of the part that starts the file.
    digest = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("decimal(38,0)")
    fields = F.length("value") - F.length(F.replace("value", F.lit(sep), F.lit(""))) + 1
    found = lines.groupBy("file").agg(
        F.min(F.struct("start", "row", "value")).alias("first"), F.count(F.lit(1)).alias("lines"),
        F.count_if(fields != columns).alias("bad"), F.sum(digest).alias("sum"),
    )
    header = F.col("first.value")
    own = F.conv(F.substring(F.md5(header), 1, 8), 16, 10).cast("decimal(38,0)")
    off = F.length(header) - F.length(F.replace(header, F.lit(sep), F.lit(""))) + 1 != columns
    return found.select(
        "file", (F.col("lines") - 1).alias("records"), header.alias("header"),
        (F.col("bad") - off.cast("bigint")).alias("bad_records"), (F.col("sum") - own).cast("bigint").alias("checksum"),
    )


def reconcile_files(expected: DataFrame, found: DataFrame) -> DataFrame:
    """``expected`` (file, records, header, checksum) against ``check_files``: (file, missing, unexpected, records_ok,
    header_ok, checksum_ok, bad_records) for every file of either; the checks are false where one side lacks it."""
    e, f = expected.alias("e"), found.alias("f")
    same = {f"{c}_ok": F.coalesce(F.col(f"e.{c}") == F.col(f"f.{c}"), F.lit(False)) for c in ("records", "header", "checksum")}
    return e.join(f, F.col("e.file") == F.col("f.file"), "full").select(
        F.coalesce("e.file", "f.file").alias("file"), F.col("f.file").isNull().alias("missing"), F.col("e.file").isNull().alias("unexpected"),
        *[v.alias(k) for k, v in same.items()], F.col("f.bad_records").alias("bad_records"),
    )
