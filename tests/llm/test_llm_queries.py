"""Every query of the folder that SQL can state, against its SQL twin."""

import os
from pathlib import Path

import duckdb
import pytest

from cohortry.llm import ORACLES, QUERIES

from ..compare import mismatch
from ..conftest import SMALL

SF_DIR = os.environ.get("TEST_SF_DIR", SMALL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_names():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
