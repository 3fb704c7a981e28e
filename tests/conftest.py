import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from penprint.session import build_session

    session = build_session("tests", 8, spark__sql__shuffle__partitions="8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def one(spark):
    """Apply a column function to one string."""

    def run(value, fn):
        return spark.createDataFrame([(value,)], "text string").select(fn("text").alias("x")).first()["x"]

    return run
