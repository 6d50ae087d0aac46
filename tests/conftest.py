import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from rillhouse.session import build_session
    session = build_session("tests", master="local[4]", shuffle_partitions=4, conf={
        "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.driver.bindAddress": "127.0.0.1", "spark.driver.host": "127.0.0.1"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
