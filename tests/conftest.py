import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from wattline.session import get_session
    ckpt = tempfile.mkdtemp(prefix="wattline-test-ckpt-")
    s = get_session("local[4]", app="wattline-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
