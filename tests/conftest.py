from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lathework.session import drop_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=os.environ.get("TEST_CPUS", "8"))
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
