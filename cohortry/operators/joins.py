"""Joins of event tables with codelists, lookups and patients.

A side is broadcast only after its rows were counted against a limit; beyond the limit the same join
runs as a shuffle join, where adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
_PER_ROW, _PER_FIELD = 16, 8


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; reads no further than it needs to know."""
    return df.limit(rows + 1).count() <= rows


def fits(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether all rows of ``df``, texts at their real length, stay within the limit for a broadcast.

    This runs ``df`` up to the limit, so what comes here should be a stored table or a cheap selection
    from one; ``materialise`` stores the result of longer work first.
    """
    limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    width = _PER_ROW + _PER_FIELD * len(df.columns)
    most = limit // width
    length = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c in texts], F.lit(0))
    found = df.select(length.alias("length")).limit(most + 1).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("text")).first()
    return found.n <= most and found.n * width + (found.text or 0) <= limit


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    return F.broadcast(df) if fits(df, max_bytes) else df


def join_codes(events: DataFrame, codes: DataFrame, code: str, how: str = "inner") -> DataFrame:
    """``events`` joined with ``codes`` on events.``code`` = codes.code, without the latter.

    Where the two types differ both are compared as text: 007 is not 7, and no code has to be a number.
    """
    if events.schema[code].dataType == codes.schema["code"].dataType:
        return events.join(codes.withColumnRenamed("code", code), code, how)
    key = F.col(code).cast("string")
    texts = codes.withColumn("code", F.col("code").cast("string")).withColumnRenamed("code", "_code_text")
    return events.withColumn("_code_text", key).join(texts, "_code_text", how).drop("_code_text")


def codelist_filter(events: DataFrame, codes: DataFrame, code: str, term: str | None = None) -> DataFrame:
    """Events whose code is in the list, each once however often the list repeats the code.

    ``term`` names a column to receive the code's term; without it this is a plain semi join.
    """
    if term is None:
        return join_codes(events, broadcast_if_small(codes.select("code")), code, "left_semi").select(*events.columns)
    unique = codes.groupBy("code").agg(F.min("term").alias(term))
    return join_codes(events, broadcast_if_small(unique), code).select(*events.columns, term)


def tag_events(events: DataFrame, lists: DataFrame, code: str, term: str | None = None) -> DataFrame:
    """Events with the name of each list that holds their code: one row per event and list."""
    if term is None:
        rows = lists.select("list_name", "code")
        tags = rows.distinct()
    else:
        rows = lists.select("list_name", "code", "term")
        tags = rows.groupBy("list_name", "code").agg(F.min("term").alias(term))
    # Lists that are small with all their repeats need no second look.
    small = fits(rows) or fits(tags)
    return join_codes(events, F.broadcast(tags) if small else tags, code)


def attach_patient_attrs(
    events: DataFrame, patients: DataFrame, attrs: Sequence[str], how: str = "left", key: str = "patid"
) -> DataFrame:
    return events.join(broadcast_if_small(patients.select(key, *attrs)), key, how)


def patient_semi(events: DataFrame, patients: DataFrame, key: str = "patid") -> DataFrame:
    """Events of the given patients."""
    return events.join(broadcast_if_small(patients.select(key)), key, "left_semi").select(*events.columns)


def patient_anti(patients: DataFrame, excluded: DataFrame, key: str = "patid") -> DataFrame:
    """Patients not among ``excluded``, whose keys are made unique before they are shuffled."""
    return patients.join(excluded.select(key).distinct(), key, "left_anti").select(*patients.columns)


def lookup_join(events: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join to a dictionary (units, terms); a row without an entry keeps null."""
    return events.join(broadcast_if_small(lookup), key, "left")


def acceptable_join(df: DataFrame, flags: DataFrame, key: str = "patid", flag: str = "acceptable") -> DataFrame:
    good = flags.filter(F.col(flag).cast("string") == "1").select(key).distinct()
    return df.join(good, key, "left_semi").select(*df.columns)


def composite_key_join(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on all key parts; joined text such as 1+23 and 12+3 could not be told apart."""
    return df.join(other, list(keys), how)


def attach_ethnicity(patients: DataFrame, ethnicity: DataFrame, key: str = "patid", how: str = "inner") -> DataFrame:
    """Add ``Ethnic``. With the default, patients without a row are dropped."""
    return patients.join(ethnicity.select(key, F.col("ethnic_6").alias("Ethnic")), key, how)


def _ordered_bands(bands: DataFrame) -> DataFrame:
    """(_group, _low, _high, _code) with open ends as infinities; bands that overlap or are empty are an error."""
    ends = bands.select(
        F.col("group").cast("string").alias("_group"), F.coalesce(F.col("low").cast("double"), F.lit(float("-inf"))).alias("_low"),
        F.coalesce(F.col("high").cast("double"), F.lit(float("inf"))).alias("_high"), F.col("code").alias("_code"),
    ).filter("_group IS NOT NULL")
    sooner = Window.partitionBy("_group").orderBy("_low", "_high").rowsBetween(Window.unboundedPreceding, -1)
    wrong = ends.withColumn("_before", F.max("_high").over(sooner)).filter("_before > _low OR _low >= _high OR isnan(_low) OR isnan(_high)")
    if (found := wrong.orderBy("_group", "_low").first()) is not None:
        raise ValueError(f"bands of group {found._group} overlap or are empty at ({found._low}, {found._high}]")
    return ends


def band_join(rows: DataFrame, bands: DataFrame, group: str, value: str, code: str = "level") -> DataFrame:
    """``rows`` with ``code``, the code of the band (low, high] of the row's group that holds the value.

    ``bands`` is a table (group, low, high, code), where a null low or high leaves that end open; groups meet as
    text. A row in a gap, of an unknown or null group, or whose value is null, no number or NaN, gets null. Every
    group's span is cut into as many cells as it has bands and a band stands in each cell it touches, so bands that
    do not overlap make at most two entries a band, and a row meets those of its own cell only.
    """
    ends = _ordered_bands(bands)
    inner = lambda c: F.when(~F.abs(c).isin(float("inf")), F.col(c))
    spans = ends.groupBy("_group").agg(
        F.least(F.min(inner("_low")), F.min(inner("_high"))).alias("_from"), F.greatest(F.max(inner("_low")), F.max(inner("_high"))).alias("_to"),
        F.count(F.lit(1)).cast("double").alias("_cells"),
    )

    def cell(x: str) -> Column:
        """Never falls as x grows, so a value's cell lies between those of its band's ends."""
        place = (F.col(x) - F.col("_from")) * (F.col("_cells") / (F.col("_to") - F.col("_from")))
        return F.when(F.col("_to") > F.col("_from"), F.floor(F.least(F.greatest(place, F.lit(0.0)), F.col("_cells") - 1)).cast("long")).otherwise(F.lit(0).cast("long"))

    entries = ends.join(spans, "_group").select("_group", F.explode(F.sequence(cell("_low"), cell("_high"))).alias("_cell"), "_low", "_high", "_code")
    marked = rows.withColumns({"_group": F.col(group).cast("string"), "_value": F.col(value).try_cast("double")})
    marked = marked.join(broadcast_if_small(spans), "_group", "left").withColumn("_cell", cell("_value")).drop("_from", "_to", "_cells")
    inside = (F.col("r._value") > F.col("b._low")) & (F.col("r._value") <= F.col("b._high"))
    same = (F.col("r._group") == F.col("b._group")) & (F.col("r._cell") == F.col("b._cell"))
    found = marked.alias("r").join(broadcast_if_small(entries).alias("b"), same & inside, "left")
    return found.select(*[F.col(f"r.`{c}`") for c in rows.columns], F.col("b._code").alias(code))


def outer(left: DataFrame, right: DataFrame, key: str = "patid") -> DataFrame:
    return left.join(right, key, "full_outer")


def full_outer_fold(frames: Sequence[DataFrame], key: str = "patid") -> DataFrame:
    """One row per key of any frame, with the columns of all of them.

    Each frame holds a key at most once and columns of its own, so stacking the rows and taking each
    column's only value per key gives the outer join of any number of frames with a single shuffle. A
    column that two frames have is an error at once, a key that one frame has twice when the job runs.
    """
    names = [c.lower() for f in frames for c in f.columns if c != key]
    if len(names) != len(set(names)):
        raise ValueError("the frames share column names: " + ", ".join(sorted({n for n in names if names.count(n) > 1})))
    marked = [f.withColumn("_frame", F.lit(i)) for i, f in enumerate(frames)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    columns = [c for c in stacked.columns if c not in (key, "_frame")]
    most = [F.count_if(F.col("_frame") == i).alias(f"_n{i}") for i in range(len(frames))]
    folded = stacked.groupBy(key).agg(*[F.first(F.col(f"`{c}`"), ignorenulls=True).alias(c) for c in columns], *most)
    twice = F.raise_error(F.lit(f"a frame holds a {key} twice")).cast(stacked.schema[key].dataType)
    once = F.when(F.exists(F.array(*[f"_n{i}" for i in range(len(frames))]), lambda n: n > 1), twice).otherwise(F.col(key))
    return folded.select(once.alias(key), *[F.col(f"`{c}`") for c in columns])


def left_fold(base: DataFrame, frames: Sequence[DataFrame], key: str = "patid") -> DataFrame:
    """Rows of ``base`` with the columns of all frames: the frames are folded first, then joined once."""
    return base.join(full_outer_fold(frames, key), key, "left")
