import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ballotlake.session import get_session
    s = get_session("local[*]", app="ballotlake-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path
