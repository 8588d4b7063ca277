"""Operators for preparing training text, each with its registered query."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
