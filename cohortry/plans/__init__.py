"""All registered queries."""

from . import basics, cohorts, effects, statistics, whole  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
