from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemill.session import local_session, release_staged  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_staged(session)
    session.stop()


def rows(df):
    """Rows as sorted tuples, nulls allowed."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
