import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tickwise.config import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tickwise-tests", master="local[*]",
                            extra={"spark.sql.shuffle.partitions": "8",
                                   "spark.default.parallelism": "8"})
    if not session.conf.get("spark.checkpoint.dir", None) and not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickwise-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="tickwise-test-")
