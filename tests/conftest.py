import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from sensorlake.session import get_spark
    # the checkpoint folder comes from the session (spark.checkpoint.dir); only when it
    # is unset does ensure_checkpoint_dir create a scratch one
    s = get_spark("local[4]", app="sensorlake-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
