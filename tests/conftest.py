import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)      # unset in tests: a fresh scratch folder
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
