import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tastegraph.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "tests")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples in the given column order."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)

    return collect
