import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from trendlake.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    checkpoint_dir(s)  # uses spark.checkpoint.dir, or a private temp folder when unset (local only)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="trendlake-test-")
