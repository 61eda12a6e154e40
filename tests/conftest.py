import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelweave.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="panelweave-tests-"),
    )
    made.sparkContext.setLogLevel("OFF")
    yield made
    made.stop()


@pytest.fixture
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def rows():
    """Sorted tuples of a result."""
    key = lambda row: tuple((v is None, str(type(v)) if v is None else "", v if v is not None else 0) for v in row)
    return lambda df, *cols: sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=key)
