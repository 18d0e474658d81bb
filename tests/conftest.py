"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyweave.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
