import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from voxsift.session import ensure_checkpoint_dir, local_session
    s = local_session("4", shuffle_partitions=8, app="voxsift-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
