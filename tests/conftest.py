import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugeline.session import build_session, clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "gaugeline-tests",
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()
