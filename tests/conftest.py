import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratalake.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    started = session(
        "tests",
        spark__master="local[4]",
        spark__driver__memory="4g",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    started.sparkContext.setLogLevel("ERROR")
    yield started
    started.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect
