import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from regloom.session import ensure_checkpoint_dir, local_session
    s = local_session(cores=8, shuffle_partitions=8)
    ensure_checkpoint_dir(s)
    yield s
