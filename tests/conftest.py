import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from tripstar.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layout(tmp_path):
    from tripstar.sources.layers import Layout

    (tmp_path / "raw").mkdir()
    return Layout(raw=str(tmp_path / "raw"), root=str(tmp_path / "tables"))
