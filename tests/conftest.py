import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from harmonia.session import checkpoint_dir, get_session
    s = get_session("local[4]", 8, app_name="harmonia-tests")
    checkpoint_dir(s)  # sets a local folder only when the session names none
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
