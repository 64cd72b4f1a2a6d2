import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session

    ckpt = tempfile.mkdtemp(prefix="ledgerline-test-")
    s = build_session("local[4]", 8, app="ledgerline-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture
def ws(spark):
    from ledgerline.session import Workspace

    return Workspace(spark)


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
