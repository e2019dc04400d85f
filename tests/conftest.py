import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cargoloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[1])
    yield session
    session.stop()


@pytest.fixture
def as_of():
    return datetime(2024, 12, 26, 10, 0)


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def sorted_rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return sorted_rows
