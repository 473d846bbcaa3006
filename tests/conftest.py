import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from prelaunch.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", app="prelaunch-tests", shuffle_partitions=8)
    checkpoint_dir(s, tempfile.mkdtemp(prefix="prelaunch-test-ckpt-"))
    yield s
    s.stop()
