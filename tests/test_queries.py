"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__
from cohortry.plans import ORACLES, QUERIES

from .compare import connect, mismatch
from .conftest import SMALL

SF_DIR = os.environ.get("TEST_SF_DIR", SMALL)
# The smallest tables leave too few patients for statistics on the research dataset.
COHORT_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def duck_cohort():
    return connect(COHORT_DIR)


WHOLE = sorted(n for n in ORACLES if n.startswith(("whole_", "case_")) and n != "case_recode")


@pytest.mark.parametrize("name", WHOLE)
def test_whole_path_same_as_sql(spark, duck_cohort, name):
    assert mismatch(QUERIES[name](spark, COHORT_DIR), duck_cohort, ORACLES[name]) is None


def test_whole_cohort_is_large_enough(spark):
    found = QUERIES["whole_cohort"](spark, COHORT_DIR)
    assert found.count() >= 200
    assert {r.outcome for r in found.select("outcome").distinct().collect()} == {0, 1, 2}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(WHOLE)))
def test_same_as_sql(spark, duck, name):
    assert mismatch(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_points(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
