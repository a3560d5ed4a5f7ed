import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session

    s = local_session("4", shuffle_partitions=4, app="ledgerline-tests")
    # tests own their checkpoint area (a cluster names a shared one in spark.checkpoint.dir)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
