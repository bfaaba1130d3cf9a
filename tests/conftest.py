import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourloom.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    conf["spark.checkpoint.dir"] = str(tmp_path_factory.mktemp("shared"))
    session = get_spark("tests", "local[8]", 4, conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
