"""One local session for all tests; a task may fail once, scratch is below pytest's own folder."""

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                os.path.dirname(os.path.abspath(__file__))]

from landinglake import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8,2]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(root / "scratch"),
        "spark.sql.warehouse.dir": str(root / "warehouse")})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture
def folder(tmp_path):
    """A new folder as text, for paths given to Spark."""
    return str(tmp_path)


@pytest.fixture
def new_table(request):
    """A table name no other test uses."""
    import uuid
    return f"t_{uuid.uuid4().hex}"
