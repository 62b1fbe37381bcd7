import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYTHONPATH", ROOT)


@pytest.fixture(scope="session")
def spark():
    from callpulse.session import get_session

    s = get_session("local[4]", shuffle_partitions=8, app="callpulse-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="callpulse-test-ckpt-"))
    yield s
    s.stop()
