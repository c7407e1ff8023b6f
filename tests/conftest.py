import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from permitry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=int(os.environ.get("TEST_CORES", "8")), partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is not None, x) for x in t))
    return collect
