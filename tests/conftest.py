import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def out_dir():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="session")
def lines(spark):
    """Texts as a one-column frame."""
    return lambda *texts, name="line": spark.createDataFrame([(t,) for t in texts], f"{name} STRING")
