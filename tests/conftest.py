import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellflow.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    yield session(partitions=4, memory="4g")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
