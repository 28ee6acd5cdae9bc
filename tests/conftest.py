import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Values of an expression over one-column rows, in order."""

    def run(values, expression, dtype="string"):
        rows = spark.createDataFrame(
            [(i, v) for i, v in enumerate(values)], f"i int, v {dtype}"
        )
        return [r[0] for r in rows.orderBy("i").select(expression).collect()]

    return run
