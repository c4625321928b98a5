import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from concord.session import local_session
    s = local_session(cpus=4, shuffle_partitions=8, app_name="concord-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="concord-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="concord-test-")
