import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from changeloom import get_spark, checkpoint_dir
    s = get_spark(app="changeloom-tests", master="local[4]", shuffle_partitions=8, driver_memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
