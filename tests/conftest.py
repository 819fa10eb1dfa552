import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from roadstream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "roadstream-tests", "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="roadstream-wh-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
