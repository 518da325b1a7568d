import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from legweave import scratch  # noqa: E402
from legweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    scratch.clear(session)
    session.stop()


@pytest.fixture
def rows():
    """Collects a DataFrame to sorted tuples."""

    def collect(df, *names):
        picked = df.select(*names) if names else df
        return sorted((tuple(r) for r in picked.collect()), key=str)

    return collect
