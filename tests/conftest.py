import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pluvio.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="pluvio-tests")
    s.conf.set("spark.sql.session.timeZone", "UTC")
    if not s.sparkContext.getCheckpointDir():
        # tests only: the cluster names a shared folder in spark.checkpoint.dir
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pluvio-ckpt-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
