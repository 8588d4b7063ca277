"""Date columns: parsing, fallbacks, offsets, ages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FORMAT = "dd/MM/yyyy"
DAYS_PER_YEAR = 365.25


def as_date(df: DataFrame, name: str, fmt: str = DATE_FORMAT) -> Column:
    """``name`` as a date: text is parsed (bad text gives null), dates pass unchanged."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(name)
    return F.try_to_date(F.col(name).cast("string"), fmt)


def parse_dates(df: DataFrame, *names: str, fmt: str = DATE_FORMAT) -> DataFrame:
    return df.withColumns({n: as_date(df, n, fmt) for n in names})


def effective_date(event: str, entry: str) -> Column:
    """Event date, or the date the record was entered where the event date is missing."""
    return F.coalesce(F.col(event), F.col(entry))


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(later, earlier)


def date_offset(date: str | Column, days: int | Column) -> Column:
    return F.date_add(date, days)


def _safe_date(year: Column, month: Column, day: int) -> Column:
    """``make_date`` that gives null, not an error, for a year or month out of range."""
    year, month = year.try_cast("int"), month.try_cast("int")
    return F.when(year.between(1, 9999) & month.between(1, 12), F.make_date(year, month, F.lit(day)))


def birthday_bound(yob: str | Column = "yob", years: int = 18) -> Column:
    """Latest day on which someone born in ``yob`` is taken to turn ``years``: 31 July."""
    yob = F.col(yob) if isinstance(yob, str) else yob
    return F.add_months(_safe_date(yob, F.lit(7), 31), 12 * years)


def assumed_birthday(yob: str = "yob", mob: str = "mob") -> Column:
    """End of the birth month where the month is known, else 31 July of the birth year."""
    known = F.last_day(_safe_date(F.col(yob), F.col(mob), 1))
    return F.when(F.col(mob).isNotNull(), known).otherwise(_safe_date(F.col(yob), F.lit(7), 31))


def age_at(date: str, yob: str = "yob", mob: str = "mob") -> Column:
    """Whole years from the assumed birthday to ``date``, a year being 365.25 days."""
    return F.floor(F.datediff(date, assumed_birthday(yob, mob)) / F.lit(DAYS_PER_YEAR)).cast("int")


# Whole numbers that sort like records, so that the first or last record of a group is the min or max of a
# long: a hash aggregate with a fixed buffer, where a struct needs a sort.


def packed_day(day: Column) -> Column:
    """The day as a number from 0 to 2 ** 32 - 1 in the order of time; null stays null."""
    return F.unix_date(day).cast("bigint") + F.lit(1 << 31)


def unpacked_day(number: Column) -> Column:
    return F.date_from_unix_date((number - F.lit(1 << 31)).cast("int"))


def pack_pick(day: Column, rank: Column, undated_last: bool) -> Column:
    """(day, rank from 0 to 7) as a long in that order, records without a day first or last."""
    undated, dated = (1, 0) if undated_last else (0, 1)
    base = F.when(day.isNull(), F.lit(undated << 35)).otherwise(F.lit(dated << 35) + F.shiftleft(packed_day(day), 3))
    return base + rank


def unpack_pick(packed: Column, undated_last: bool) -> tuple[Column, Column]:
    """Day and rank of ``pack_pick``."""
    undated = F.shiftright(packed, 35) == (1 if undated_last else 0)
    number = F.shiftright(packed, 3).bitwiseAND(F.lit((1 << 32) - 1))
    return F.when(~undated, unpacked_day(number)), packed.bitwiseAND(F.lit(7)).cast("int")


def pack_last(day: Column, amount: Column) -> Column:
    """(day, int) as a long in that order, a null amount below all others. Days of the years -30,000 to 30,000."""
    low = F.coalesce(amount.cast("bigint") + F.lit((1 << 31) + 1), F.lit(0))
    return F.shiftleft(F.unix_date(day).cast("bigint") + F.lit(1 << 24), 33) + low


def unpack_last(packed: Column) -> tuple[Column, Column]:
    """Day and amount of ``pack_last``."""
    low = packed.bitwiseAND(F.lit((1 << 33) - 1))
    return F.date_from_unix_date((F.shiftright(packed, 33) - F.lit(1 << 24)).cast("int")), F.when(low > 0, (low - F.lit((1 << 31) + 1)).cast("int"))
