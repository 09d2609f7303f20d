import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from custos.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def duck():
    from tests.oracle import duck as mk
    return mk(SF_SMALL)
