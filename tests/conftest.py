import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rillet.session import get_session
    s = get_session("local[*]", 8)
    # tests own a private shared folder only when the session names none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rillet-test-"))
    yield s
    from rillet.session import clear_scratch
    clear_scratch(s)


@pytest.fixture()
def scratch(spark):
    from rillet.session import scratch_path
    return scratch_path(spark, "test")
