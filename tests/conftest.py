import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from reelmart.session import local_session
    s = local_session("*", 8, app="reelmart-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="reelmart-test-")


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
