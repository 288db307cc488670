import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater import build_session

    extra = {}
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        # Tests only: a local checkpoint root when the session has none.
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tidewater-tests-")
    s = build_session("local[*]", 8, app_name="tidewater-tests", extra=extra)
    yield s
    s.stop()
