import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from daybook.session import local_session

    s = local_session("*", 4, app="daybook-tests")
    yield s
    s.stop()


@pytest.fixture
def tmpdir_path(tmp_path):
    return str(tmp_path)
