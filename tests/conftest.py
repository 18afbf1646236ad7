from __future__ import annotations

import sys
from pathlib import Path

import pytest

HERE = Path(__file__).parent
sys.path[:0] = [str(HERE), str(HERE.parent)]

from subtide.session import local_session  # noqa: E402
from subtide.sources import drop_written  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", memory="6g")
    yield session
    drop_written(session)
    session.stop()
