import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from parcelwing.session import build_session

    session = build_session("tests", cores="4", shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def context(spark):
    from parcelwing.catalog.registry import Context

    return Context(spark, FOLDER)


@pytest.fixture
def at():
    """Timestamp from text."""
    return lambda text: dt.datetime.fromisoformat(text)
