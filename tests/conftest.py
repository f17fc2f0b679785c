import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quirework.session import local_session

    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    import compare

    return compare.connect(SMALL)
