import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hourlake.session import build_session
    root = tempfile.mkdtemp(prefix="hourlake-tests-")
    s = build_session("local[4]", app="hourlake-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": os.path.join(root, "ckpt"),
                             "hourlake.warehouse.dir": os.path.join(root, "wh")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="hourlake-t-")
