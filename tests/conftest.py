import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from phenoscope.session import get_session
    session = get_session("local[2]", 4, app_name="phenoscope-tests")
    yield session
