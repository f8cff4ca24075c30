import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickspark.session import get_spark
    # tests are the one place where we set the shared checkpoint folder ourselves
    s = get_spark("local[4]", 4, app="tickspark-tests",
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tickspark-tests-")})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
