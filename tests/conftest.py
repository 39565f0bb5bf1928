import os

import pytest

from larkspur.session import local_session
from larkspur.sources.tables import Tables
from tests.oracle import TESTDATA, connect

FOLDER = f"{TESTDATA}/sf{os.environ.get('TEST_SF', '0.001')}"


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), "tests", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.fixture(scope="session")
def duck():
    return connect(FOLDER)
