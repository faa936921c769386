import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from salespark.session import build_session, checkpoint_root
    s = build_session("local[4]", app="salespark-tests", shuffle_partitions=4)
    checkpoint_root(s)  # uses the session's folder, or creates one for local runs
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
