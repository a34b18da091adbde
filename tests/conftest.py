import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cadence.session import local_session

    session = local_session(cores="*", shuffle_partitions=8)
    # Tests set their own shared folder only where the session has none.
    if not session.sparkContext.getCheckpointDir():
        configured = session.conf.get("spark.checkpoint.dir", None)
        session.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="cadence-test-")
