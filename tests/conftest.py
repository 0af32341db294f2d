import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkweft.plans.session import local_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "6g", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(DATA):
        pytest.skip("test tables are not here")
    return DATA
