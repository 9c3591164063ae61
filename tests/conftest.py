import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starmart.session import get_spark

    s = get_spark(app="starmart-tests", master="local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-ckpt-"))
    yield s


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)
