import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelfsync.session import get_spark, work_dir

    s = get_spark("shelfsync-tests", cpus="4", shuffle_partitions=4)
    work_dir(s)
    yield s


@pytest.fixture()
def store_root(tmp_path):
    return str(tmp_path / "store")
