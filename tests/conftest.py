import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from panelkit.session import local_session  # noqa: E402


# column expressions at module level need a running session
SESSION = local_session(8, "panelkit-tests", "6g")
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def rows(spark):
    """Build a frame from a schema string and tuples."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def evaluate(spark):
    """Evaluate column expressions for a list of Python values."""

    def run(values, kind, *expressions):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        found = frame.select("i", *[e.alias(f"r{n}") for n, e in enumerate(expressions)]).orderBy("i").collect()
        return [tuple(r)[1:] if len(expressions) > 1 else r["r0"] for r in found]

    return run
