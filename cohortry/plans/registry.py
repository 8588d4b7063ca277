"""Named queries: a function on the views and, where it can be said so, the same query as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **ctes: str):
    """Register a function from views to a result; ``ctes`` are further named parts of the SQL text."""

    def register(fn: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql, **ctes)
        return fn

    return register
