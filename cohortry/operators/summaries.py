"""One scan and one shuffle per event table.

An operator on events states which codes it needs, under role names, and which aggregates over the
tagged events. Any number of operators are then served by a single broadcast join and a single
``groupBy(patid)``; each aggregate keeps a bounded state per patient, so a patient with very many
events is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_dates
from ..sources.codelists import long_codelist
from .joins import tag_events
from .keyfilter import early_codes

ROLE, TERM, ON = "_role", "_term", "_on"


@dataclass
class Part:
    """What one operator needs: codelist rows named by role, aggregates, and the event columns they read.

    Aggregates may use the role number (``in_role``, ``role_sql``), the code's term and ``ON``, the
    event's effective date.
    """

    lists: DataFrame
    aggregates: list[Column]
    columns: list[str] = field(default_factory=list)


def role(codes: DataFrame, name: str) -> DataFrame:
    """The codes of one list under a role name."""
    return codes.select(F.lit(name).alias("list_name"), "code", "term")


def prefixed(lists: DataFrame, prefix: str) -> DataFrame:
    return lists.select(F.concat(F.lit(prefix), "list_name").alias("list_name"), "code", "term")


def role_number(name: str | Column) -> Column:
    """Events carry the hash of the role name: numbers compare faster than names, row by row."""
    return F.xxhash64(F.lit(name) if isinstance(name, str) else name)


def in_role(*names: str) -> Column:
    hit = F.col(ROLE) == role_number(names[0])
    for name in names[1:]:
        hit = hit | (F.col(ROLE) == role_number(name))
    return hit


def role_sql(name: str) -> str:
    """The role number as SQL text, for expressions built once per list name."""
    return "xxhash64('" + name.replace("\\", "\\\\").replace("'", "\\'") + "')"


def summarise_events(
    events: DataFrame, parts: Iterable[Part], code: str, dates: Sequence[str], key: str = "patid"
) -> DataFrame:
    """One row per patient that has any event in the parts' lists, with all their aggregates."""
    parts = list(parts)
    wanted = list(dict.fromkeys([key, code, *dates, *(c for p in parts for c in p.columns)]))
    lists = long_codelist(p.lists for p in parts).withColumn("list_name", role_number(F.col("list_name")))
    rows = parse_dates(early_codes(events.select(*wanted), lists, code), *dates).withColumn(ON, F.coalesce(*dates))
    tagged = tag_events(rows, lists, code, term=TERM).withColumnRenamed("list_name", ROLE)
    return tagged.groupBy(key).agg(*[a for p in parts for a in p.aggregates])
