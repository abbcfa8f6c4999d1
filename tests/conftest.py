import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quizlake.session import build_session

    ckpt = tempfile.mkdtemp(prefix="quizlake-test-ckpt-")
    s = build_session(master="local[*]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
