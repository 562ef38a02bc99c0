import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adgrove.session import local_session  # noqa: E402


# Column expressions at module level need a session, so it starts before the test modules load.
SPARK = local_session(cpus="4", partitions=4)


@pytest.fixture(scope="session")
def spark():
    return SPARK
