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
    from tablerail.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="tablerail-tests", shuffle_partitions=8)
    # tests only: the cluster would name a shared folder in spark.checkpoint.dir
    checkpoint_dir(s, tempfile.mkdtemp(prefix="tablerail-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tablerail-test-")
