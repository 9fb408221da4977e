import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from agrolith.session import local_session

    s = local_session(4, partitions=4, name="tests")
    s.sparkContext.setLogLevel("OFF")
    yield s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
