import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import build_session
    s = build_session("local[4]", app="kestrel-tests", shuffle_partitions=4, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="kestrel-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
