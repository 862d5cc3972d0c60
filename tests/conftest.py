import os

os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")      # before numpy is imported

import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from herdcast.session import build_session
    session = build_session("local[8]", "tests", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="herdcast-tests-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
