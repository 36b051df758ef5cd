import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tastemesh.session import local_session
    s = local_session("*", 8, app_name="tastemesh-tests")
    # tests own their checkpoint folder (a cluster names a shared one)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tastemesh-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
