import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from valuelens.session import get_spark

    s = get_spark(
        app="valuelens-tests", master="local[*]", shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="valuelens-test-ckpt-"), "spark.driver.memory": "8g"},
    )
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
