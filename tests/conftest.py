import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from periodlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=8, driver_memory="4g")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pl-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="pl-test-")
