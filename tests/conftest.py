import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("QUORUM_DRIVER_MEMORY", "6g")

from quorum.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", shuffle_partitions=4)


@pytest.fixture(scope="session")
def small():
    return SMALL
