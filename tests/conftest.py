import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SMALL_SF = "/root/testdata/sf0.001"
CHECK_SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from corpuslens.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()
