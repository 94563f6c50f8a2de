import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strainwise.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a small DataFrame from rows and DDL text."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
