import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pulsegrid.session import get_session
    s = get_session("local[8]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pulsegrid-test-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh(spark):
    from pulsegrid.session import scratch_path
    return scratch_path(spark, "t")
