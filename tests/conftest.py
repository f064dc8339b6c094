import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from daymend.session import build_session, fresh_root  # noqa: E402
from daymend.sources.tables import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    return TableStore(spark, fresh_root(spark, "test"))


@pytest.fixture
def folder(spark):
    return fresh_root(spark, "testdrops")
