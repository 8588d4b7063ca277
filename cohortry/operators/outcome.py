"""Outcome of each patient, from diagnosis codes and measurements judged by group-specific limits.

0 none, 1 moderate, 2 severe, 3 undefined (a measurement whose unit cannot be used).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import (
    ACCEPTED_UNITS, CK_BANDS, CONVERTED_UNITS, TARGET_UNIT, UNDEFINED_CODE, band_code, converted_value, threshold_by_group, unit_convert,
    unit_gate,
)
from ..functions.dates import effective_date, pack_pick, parse_dates, unpack_pick
from ..sources.codelists import long_codelist
from .joins import attach_patient_attrs, tag_events
from .summaries import ON, ROLE, Part, in_role, role, role_number, summarise_events

MEASURED, MODERATE, SEVERE = "measured", "moderate", "severe"
MODES = ("earliest_positive", "first_record")


@dataclass
class OutcomeRules:
    """Codelists and limits. ``bands`` maps each group to the upper limits of codes 0 and 1."""

    measured: DataFrame
    moderate: DataFrame
    severe: DataFrame
    bands: Mapping[str, tuple[float, float]] = field(default_factory=lambda: dict(CK_BANDS))
    accepted: Sequence[int] = ACCEPTED_UNITS
    convert: Mapping[int, float] = field(default_factory=lambda: dict(CONVERTED_UNITS))
    target: int = TARGET_UNIT
    mode: str = MODES[0]
    event_date: str = "obsdate"
    entry_date: str = "enterdate"
    code: str = "medcodeid"

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {', '.join(MODES)}")
        if not self.accepted:
            raise ValueError("accepted units cannot be empty")

    @property
    def lists(self) -> DataFrame:
        return long_codelist([role(self.measured, MEASURED), role(self.moderate, MODERATE), role(self.severe, SEVERE)])

    @property
    def dates(self) -> list[str]:
        return [self.event_date, self.entry_date]


def _usable_units(rules: OutcomeRules) -> list[int]:
    """Units accepted as recorded, and those to be converted where the target unit is accepted."""
    converted = list(rules.convert) if rules.target in rules.accepted else []
    return [u for u in rules.accepted if u not in rules.convert] + converted


def _coder(rules: OutcomeRules):
    """A function from the band code of a measurement to the code of the tagged event."""
    severe, moderate, measured = in_role(SEVERE), in_role(MODERATE), in_role(MEASURED)
    units = _usable_units(rules)
    gate = unit_gate(units) if units else F.lit(UNDEFINED_CODE)
    return lambda level: F.when(severe, F.lit(2)).when(moderate, F.lit(1)).when(measured, F.coalesce(gate, level))


# On one day the most severe code counts first, an undefined one only after any definite outcome.
_CODES_BY_RANK = (2, 1, 3, 0)


def _codes_by_rank() -> Column:
    return F.array(*[F.lit(c) for c in _CODES_BY_RANK])


def outcome_part(rules: OutcomeRules) -> Part:
    """The deciding event of each patient, once for every group and once for patients of no group.

    The group is known only from the patient table. Judging each event under every group's limits
    lets events be reduced to one row per patient before they meet that table.
    """
    date, coded, value = F.col(ON), _coder(rules), converted_value(rules.convert)
    ranks, last = _codes_by_rank(), F.lit(len(_CODES_BY_RANK) + 1)
    aggregates = []
    for name, cuts in [*rules.bands.items(), (None, None)]:
        code = coded(F.lit(None).cast("int") if cuts is None else band_code(cuts, value))
        rank = F.coalesce(F.array_position(ranks, code), last)
        deciding = code > 0 if rules.mode == "earliest_positive" else in_role(MEASURED, MODERATE, SEVERE)
        pick = F.when(deciding, pack_pick(date, rank, _undated_last(rules)))
        aggregates.append(F.min(pick).alias(_column(rules, name)))
    return Part(rules.lists, aggregates, ["value", "numunitid"])


def _undated_last(rules: OutcomeRules) -> bool:
    return rules.mode == "earliest_positive"


def _column(rules: OutcomeRules, group: str | None) -> str:
    return "_outcome_other" if group is None else f"_outcome_{list(rules.bands).index(group)}"


def unpack_outcome(patients: DataFrame, rules: OutcomeRules, group: str = "gender") -> DataFrame:
    """Choose the column of the patient's group; no deciding event, or one of code 0, means no outcome."""
    chosen = F.col(_column(rules, None))
    for name in rules.bands:
        chosen = F.when(F.col(group).cast("string") == F.lit(name), F.col(_column(rules, name))).otherwise(chosen)
    out = patients.withColumn("_chosen", chosen)
    day, rank = unpack_pick(F.col("_chosen"), _undated_last(rules))
    code = F.get(_codes_by_rank(), rank - 1)
    out = out.withColumn("outcome", F.coalesce(code, F.lit(0)))
    out = out.withColumn("outcome_date", F.when(F.col("outcome") > 0, day))
    return out.drop("_chosen", _column(rules, None), *[_column(rules, g) for g in rules.bands])


def add_outcome(patients: DataFrame, events: DataFrame, rules: OutcomeRules, group: str = "gender") -> DataFrame:
    """Patients with ``outcome`` and ``outcome_date``; patients without a record get 0.

    ``earliest_positive`` takes the first event with a code above 0. ``first_record`` takes the very
    first listed event, dated or not, and only if its code is above 0.
    """
    summary = summarise_events(events, [outcome_part(rules)], rules.code, rules.dates)
    return unpack_outcome(patients.join(summary, "patid", "left"), rules, group)


def outcome_events(patients: DataFrame, events: DataFrame, rules: OutcomeRules, group: str = "gender") -> DataFrame:
    """Every listed event with its code and date, measurements in the target unit: the detail behind ``add_outcome``."""
    rows = tag_events(parse_dates(events, *rules.dates), rules.lists, rules.code).withColumn(ROLE, role_number(F.col("list_name")))
    rows = attach_patient_attrs(rows, patients, [group])
    level = threshold_by_group(rules.bands, group, converted_value(rules.convert))
    rows = rows.withColumn("outcome_code", _coder(rules)(level)).drop(ROLE)
    rows = unit_convert(rows, rules.convert, rules.target)
    return rows.withColumn("outcome_date", effective_date(*rules.dates))


def exclude_prior_outcome(patients: DataFrame, index_date: str = "first_exposure_date") -> DataFrame:
    """Drop patients with an outcome before the index date (the same day is kept) or an undefined one."""
    return patients.filter(no_prior_outcome(index_date))


def no_prior_outcome(index_date: str = "first_exposure_date") -> Column:
    prior = F.coalesce(F.col("outcome_date") < F.col(index_date), F.lit(False))
    return ~prior & (F.col("outcome") != 3)
