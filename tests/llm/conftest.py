from __future__ import annotations

import pytest

from subtide.llm.common import ready


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ready(spark)
