"""Helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What separates words, the space and the code points 9 to 13.
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (Spark ignores case in names)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def whole(text: str | Column = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def joined_words(text: Column) -> Column:
    """The words of a text with one space between them."""
    return F.regexp_replace(F.btrim(text, F.lit(WORD_SPACE)), WORD_GAP, " ")


def first_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of ``keys``, the one whose other columns come first, compared in turn; without ``keys``.

    An aggregate, so each task sends one row a key at most, and the row does not depend on the partitions.
    """
    one = fresh(rows, "first_row")
    others = [F.col(f"`{c}`") for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias(one)).select(f"{one}.*")


def ranked(rows: DataFrame, key: str, order: list[str], place: str, size: str) -> DataFrame:
    """``rows`` with ``place``, the number of rows before it among those of its ``key``, and ``size``, their number.

    Nulls come first, of the key too. The rows have to be stored, as their numbers in the scan end the
    order: they are dealt out in ranges, so that no key, or group of equal rows, lands in one task, and only
    a count for each key and range is added up.
    """
    from ..sources.tables import materialise

    at, part, before, n, first, group = (fresh(rows, f"{place}_{x}") for x in ("at", "part", "before", "n", "first", "group"))
    by = [F.col(c).asc_nulls_first() for c in [key, *order, at]]
    numbered = rows.withColumn(at, F.monotonically_increasing_id())
    spread = materialise(numbered.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(at, F.monotonically_increasing_id()))
    spread = spread.withColumn(part, F.shiftright(at, 33))
    counts = spread.groupBy(F.col(key).alias(group), part).agg(F.count(F.lit(1)).alias(n), F.min(at).alias(first))
    sooner = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        group, F.col(part).alias(f"{part}_"), first, F.coalesce(F.sum(n).over(sooner), F.lit(0)).alias(before),
        F.sum(n).over(Window.partitionBy(group)).alias(size),
    )
    found = spread.join(counts, F.col(key).eqNullSafe(F.col(group)) & (F.col(part) == F.col(f"{part}_")))
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col(at) - F.col(first) + F.col(before)).alias(place), size)
