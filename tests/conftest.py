import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from quadloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, bytes as bytes."""

    def plain(value):
        return bytes(value) if isinstance(value, bytearray) else value

    def get(df, *names):
        picked = df.select(*(names or df.columns)).collect()
        return sorted((tuple(plain(x) for x in r) for r in picked), key=repr)

    return get
