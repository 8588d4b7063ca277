import pytest

from cohortry.plans.views import Views
from cohortry.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, 4)


@pytest.fixture(scope="session")
def views(spark):
    return Views(spark, SMALL)
