from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rivermill.config import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="2",
        spark__driver__memory="4g",
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
