import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from motifspark.session import get_spark
    s = get_spark("local[4]", app="motifspark-tests", shuffle_partitions=8,
                  conf={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="motifspark-test-")
