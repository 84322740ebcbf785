import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from studyloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions over one row of text values."""
    def run(expression, **values):
        names = list(values) or ["_none"]
        schema = ", ".join(f"{n} string" for n in names)
        row = tuple(values.values()) or (None,)
        return spark.createDataFrame([row], schema).select(expression.alias("r")).first().r
    return run
