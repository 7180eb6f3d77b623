import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from chalkline.session import build_session
    extra = {}
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        # tests only: the cluster names its own shared folder
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="chalkline-test-")
    s = build_session("local[4]", 8, app_name="chalkline-tests", extra=extra)
    yield s


@pytest.fixture()
def scratch(spark):
    from chalkline.session import scratch_path
    return lambda name: scratch_path(spark, name)
