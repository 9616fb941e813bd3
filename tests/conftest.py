import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shoplake.session import build_session

    s = build_session(master="local[4]", app="shoplake-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shoplake-test-ckpt-"))
    yield s
    from shoplake.session import delete_path, scratch_path
    delete_path(s, scratch_path(s))  # this session's own scratch folders
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from shoplake.session import scratch_path

    return scratch_path(spark, "tests", unique=True)
