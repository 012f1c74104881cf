import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starloom.session import build_session
    scratch = tempfile.mkdtemp(prefix="starloom-test-")
    s = build_session("local[4]", 8, app_name="starloom-tests",
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.local.dir": scratch, "spark.driver.memory": "4g"})
    yield s
    s.stop()
