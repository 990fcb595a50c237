import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickpath.session import build_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_spark(master="local[4]", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="clickpath-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="clickpath-test-")
