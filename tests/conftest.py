import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ontime.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("ontime-tests", "local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
