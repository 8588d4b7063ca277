"""Compare a Spark result with the same query run in DuckDB, without regard to row order."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_cell, v)) + "]"
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return [columns[i].lower() for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def mismatch(spark_df, con, sql: str) -> str | None:
    """None where both agree in column names, types and values; else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0].lower(): str(d[1]) for d in result.description}
    want_names, want = _rows(columns, result.fetchall())
    got_names, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if want_names != got_names:
        return f"columns {got_names} != {want_names}"
    for name, kind in spark_df.dtypes:
        if kind in KINDS and not kinds[name.lower()].startswith(KINDS[kind]):
            return f"type of {name}: {kind} != {kinds[name.lower()]}"
    if len(want) != len(got):
        return f"{len(got)} rows != {len(want)}"
    if not want:
        return "both empty"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} rows differ, first got {bad[0][0]} want {bad[0][1]}" if bad else None
