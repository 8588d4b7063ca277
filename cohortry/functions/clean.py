"""Recoding, unit handling, value filters and column tidying."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unit ids and cut points of the creatine kinase rules.
ACCEPTED_UNITS = (276, 154, 49, 852, 1307, 151, 2698, 999, 153, 13350, 4548)
CONVERTED_UNITS = {155: 1000.0, 277: 1000.0}
TARGET_UNIT = 276
CK_BANDS = {"1": (1280.0, 3200.0), "2": (800.0, 2000.0)}
UNDEFINED_CODE = 3
# Treatment numbers of the research dataset.
TREATMENT_CODES = {
    "Simvastatin": 1,
    "Atorvastatin calcium trihydrate": 2,
    "Pravastatin sodium": 3,
    "Rosuvastatin calcium": 4,
    "Fluvastatin sodium": 5,
}


def require_columns(df: DataFrame, names: Iterable[str], label: str = "input") -> DataFrame:
    """Return ``df``, or raise naming the columns it lacks (names match in any case)."""
    have = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in have]
    if missing:
        raise ValueError(f"{label} must contain columns: {', '.join(missing)}")
    return df


def forbid_columns(df: DataFrame, names: Iterable[str], label: str = "input") -> DataFrame:
    """Return ``df``, or raise naming the new columns that it already has."""
    have = {c.lower() for c in df.columns}
    taken = [n for n in names if n.lower() in have]
    if taken:
        raise ValueError(f"{label} already has columns: {', '.join(taken)}")
    return df


def case_recode(column: str, mapping: Mapping[str, int] = TREATMENT_CODES) -> Column:
    """Value of ``mapping`` for each text, null for any other."""
    out = F.lit(None).cast("int")
    for text, number in mapping.items():
        out = F.when(F.col(column) == text, F.lit(number)).otherwise(out)
    return out


def unit_convert(
    events: DataFrame,
    factors: Mapping[int, float] = CONVERTED_UNITS,
    target: int = TARGET_UNIT,
    value: str = "value",
    unit: str = "numunitid",
) -> DataFrame:
    """Multiply values whose unit has a factor and move them to the target unit."""
    unit_id = F.col(unit).try_cast("int")
    moved = F.when(unit_id.isin(list(factors)), F.lit(target)).otherwise(unit_id) if factors else unit_id
    return events.withColumns({value: converted_value(factors, value, unit), unit: moved})


def converted_value(factors: Mapping[int, float] = CONVERTED_UNITS, value: str = "value", unit: str = "numunitid") -> Column:
    number = F.col(value).try_cast("double")
    out = number
    for source, factor in factors.items():
        out = F.when(F.col(unit).try_cast("int") == source, number * F.lit(factor)).otherwise(out)
    return out


def unit_gate(accepted: Sequence[int] = ACCEPTED_UNITS, unit: str = "numunitid") -> Column:
    """Code 3 (undefined) where the unit is missing or not accepted, else null."""
    if not accepted:
        raise ValueError("accepted units cannot be empty")
    known = F.coalesce(F.col(unit).try_cast("int").isin(list(accepted)), F.lit(False))
    return F.when(~known, F.lit(UNDEFINED_CODE))


def band_code(cuts: tuple[float, float], value: str | Column = "value") -> Column:
    """0 up to the first cut, 1 up to the second, 2 above; null value gives null."""
    number = F.col(value).try_cast("double") if isinstance(value, str) else value
    return F.when(number <= cuts[0], F.lit(0)).when(number <= cuts[1], F.lit(1)).when(number > cuts[1], F.lit(2))


def threshold_by_group(
    bands: Mapping[str, tuple[float, float]] = CK_BANDS, group: str = "gender", value: str | Column = "value"
) -> Column:
    """Band code by the cut points of the row's group; null for a group without bands."""
    out = F.lit(None).cast("int")
    for name, cuts in bands.items():
        out = F.when(F.col(group).cast("string") == F.lit(name), band_code(cuts, value)).otherwise(out)
    return out


def value_range_filter(
    events: DataFrame, low: float, high: float, unit_text: str | None = None,
    value: str = "value", unit: str = "unit",
) -> DataFrame:
    number = F.col(value).try_cast("double")
    kept = events.filter(number.between(low, high))
    return kept if unit_text is None else kept.filter(F.col(unit) == unit_text)


def period_filter(df: DataFrame, date: str, start=None, end=None) -> DataFrame:
    """Rows dated within the period, both ends included; an end left out is open."""
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(date) <= F.lit(end).cast("date"))
    return df


def flag_filter(df: DataFrame, flag: str = "acceptable", value: str = "1") -> DataFrame:
    return df.filter(F.col(flag).cast("string") == F.lit(value))


def value_exclude(df: DataFrame, column: str, value) -> DataFrame:
    """Drop rows holding ``value``; rows with null go too, as with a plain inequality."""
    return df.filter(F.col(column) != F.lit(value))


def fill_nulls_zero(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(names))


def drop_missing(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=None if names is None else list(names))


def rename_drop(
    df: DataFrame, renames: Mapping[str, str] | None = None, drops: Iterable[str] = (), drop_containing: str | None = None
) -> DataFrame:
    """Rename, then drop by name and by a part of the name."""
    df = df.withColumnsRenamed(dict(renames or {}))
    gone = {d.lower() for d in drops}
    return df.select(*[
        F.col(f"`{c}`") for c in df.columns
        if c.lower() not in gone and (drop_containing is None or drop_containing not in c)
    ])


def value_counts_long(df: DataFrame, names: Sequence[str], value: str = "level") -> DataFrame:
    """(variable, level, n) for every column in one scan; levels as text, null kept."""
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    long = texts.unpivot([], list(names), "variable", value)
    return long.groupBy("variable", value).agg(F.count(F.lit(1)).alias("n"))


def few_valued(df: DataFrame, names: Sequence[str], limit: int = 20) -> list[str]:
    """Columns with fewer than ``limit`` distinct non-null values.

    A one-pass sketch drops the columns that are far above the limit; the exact count, whose result
    is one row per column, is then taken only over those that are left.
    """
    sketch = df.agg(*[F.approx_count_distinct(f"`{c}`", 0.02).alias(c) for c in names]).first()
    near = [c for c in names if sketch[c] < 2 * limit]
    if not near:
        return []
    exact = df.agg(*[F.count_distinct(f"`{c}`").alias(c) for c in near]).first()
    return [c for c in near if exact[c] < limit]


def index_categories(df: DataFrame, names: Sequence[str] | None = None, limit: int = 20, keep: Iterable[str] = ()) -> DataFrame:
    """Replace each few-valued column by its index, the most frequent value being 0 (ties by text).

    The other columns become numbers: text a double, null where it is no number, and booleans 0 or 1.
    Numbers keep their types, so that long ids stay whole; dates and nested columns stay as they are.
    """
    keep = set(keep)
    asked = list(names or df.columns)
    todo = few_valued(df, [c for c in asked if c not in keep], limit)
    kinds = dict(df.dtypes)

    def number(c: str) -> Column:
        if c in asked and kinds[c] in ("string", "boolean"):
            return F.col(f"`{c}`").try_cast("double" if kinds[c] == "string" else "int").alias(c)
        return F.col(f"`{c}`")

    if not todo:
        return df.select(*[number(c) for c in df.columns])
    texts = df.withColumns({c: F.col(c).cast("string") for c in todo})
    model = StringIndexer(
        inputCols=todo, outputCols=[f"{c}__index" for c in todo], handleInvalid="keep", stringOrderType="frequencyDesc"
    ).fit(texts)
    out = model.transform(texts)
    return out.select(*[F.col(f"{c}__index").cast("int").alias(c) if c in todo else number(c) for c in df.columns])


def dedupe_column_names(df: DataFrame, suffix: str = "_dup") -> DataFrame:
    """Rename the second and later uses of a name (in any case) to name + suffix, adding it again if needed."""
    seen: set[str] = set()
    names = []
    for c in df.columns:
        while c.lower() in seen:
            c += suffix
        seen.add(c.lower())
        names.append(c)
    return df.toDF(*names)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Dots and blanks become underscores; parentheses go."""
    table = str.maketrans({".": "_", " ": "_", "(": None, ")": None})
    return df.toDF(*[c.translate(table) for c in df.columns])
