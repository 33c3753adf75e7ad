import datetime as dt
import uuid

import pytest

from eventide.session import local_session
from eventide.storage import clear_scratch, scratch_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "eventide-tests", "6g")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def folder(spark):
    return scratch_path(spark, f"test-{uuid.uuid4().hex[:6]}")


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df):
    """Rows as a sorted list of tuples, NULL first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
