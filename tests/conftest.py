import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from usagelake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Tests run in local mode: the checkpoint folder is a fresh scratch
    # folder because no cluster setting exists here.
    ckpt = tempfile.mkdtemp(prefix="usagelake-test-ckpt-")
    s = build_session("local[4]", 4, app_name="usagelake-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="usagelake-test-")
