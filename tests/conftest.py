import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from starbuild.session import build_session

    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=f"{base}/warehouse",
        spark__checkpoint__dir=f"{base}/shared",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
