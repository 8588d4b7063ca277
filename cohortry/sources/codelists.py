"""Codelists: every list, of drug or medical codes, becomes rows of one long table (list_name, code, term)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names under which code and term columns occur in codelist files, compared in lower case.
CODE_COLUMNS = ("medcodeid", "prodcodeid", "code")
TERM_COLUMNS = ("term", "drugsubstancename")


def _find(df: DataFrame, names: Iterable[str]) -> str | None:
    have = {c.lower(): c for c in df.columns}
    return next((have[n] for n in names if n in have), None)


def codelist(df: DataFrame, name: str, code: str | None = None, term: str | None = None) -> DataFrame:
    """Bring a codelist with columns named in any usual way into the long form; codes are made unique."""
    code = code or _find(df, CODE_COLUMNS)
    if code is None:
        raise ValueError(f"codelist {name} must contain columns: {', '.join(CODE_COLUMNS)}")
    term = term or _find(df, TERM_COLUMNS)
    rows = df.select(
        F.col(code).alias("code"), (F.col(term) if term else F.lit(None)).cast("string").alias("term")
    ).filter(F.col("code").isNotNull())
    return rows.groupBy("code").agg(F.min("term").alias("term")).select(F.lit(name).alias("list_name"), "code", "term")


def read_codelist(spark: SparkSession, path: str, name: str, sep: str = "\t") -> DataFrame:
    return codelist(spark.read.csv(path, sep=sep, header=True), name)


def read_codelists(spark: SparkSession, paths: Mapping[str, str], sep: str = "\t") -> DataFrame:
    return long_codelist(read_codelist(spark, path, name, sep) for name, path in paths.items())


def long_codelist(lists: Iterable[DataFrame]) -> DataFrame:
    """All lists as one; where their codes have several types they become text."""
    frames = list(lists)
    if len({f.schema["code"].dataType for f in frames}) > 1:
        frames = [f.withColumn("code", F.col("code").cast("string")) for f in frames]
    return reduce(DataFrame.unionByName, frames)


def codelist_union(lists: DataFrame) -> DataFrame:
    """Distinct codes over all lists."""
    return lists.select("code").distinct()


def codelist_split_by_term(codes: DataFrame, part: str) -> tuple[DataFrame, DataFrame]:
    """(codes with a term containing ``part`` in any case, the other codes)."""
    hit = F.coalesce(F.lower("term").contains(part.lower()), F.lit(False))
    found = codes.filter(hit)
    rest = codes.join(found.select("code").distinct(), "code", "left_anti").select(*codes.columns)
    return found, rest


def codelist_like(codes: DataFrame, pattern: str, column: str = "term") -> DataFrame:
    """Codes whose text matches an SQL pattern, such as ``%2001 census``."""
    return codes.filter(F.col(column).like(pattern))


def codelist_by_category(codes: DataFrame, category: int, column: str = "emiscodecatid") -> DataFrame:
    return codes.filter(F.col(column).try_cast("int") == category)


def codelist_from_text(spark: SparkSession, path: str) -> DataFrame:
    """Lists whose blanks both part fields and occur inside them: (Group, prodcodeid), the first two fields.

    The first character of each line, a stray quote, is left out; lines with fewer than two fields go.
    """
    line = F.expr("trim(regexp_replace(substring(value, 2), '\\\\s+', ' '))")
    parts = F.split(line, " ", 3)
    return (
        spark.read.text(path).select(parts.alias("parts")).filter(F.size("parts") >= 2)
        .select(F.col("parts")[0].alias("Group"), F.col("parts")[1].alias("prodcodeid"))
    )
