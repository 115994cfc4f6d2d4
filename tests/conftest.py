from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchline.session import local_session  # noqa: E402


# Test modules build column expressions when they are imported, which needs a session.
SESSION = local_session(shuffle_partitions=4, name="tests")
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluates a column expression on rows of text values."""

    def run(expression, rows, schema="a string"):
        data = [r if isinstance(r, tuple) else (r,) for r in rows]
        ordered = [(i, *r) for i, r in enumerate(data)]
        df = spark.createDataFrame(ordered, "_i int, " + schema)
        return [r["v"] for r in df.select("_i", expression.alias("v")).orderBy("_i").collect()]

    return run
