import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from caprank.session import build_session, ship_package

    s = build_session(master="local[*]", shuffle_partitions=8)
    ship_package(s)
    yield s
    s.stop()
