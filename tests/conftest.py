import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from hemicycle.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted for comparison."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"
