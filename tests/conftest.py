import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hitloom.session import local_session

    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, app="tests", **{"spark.checkpoint.dir": folder, "spark.driver.memory": "8g"})
    yield session
    session.stop()
