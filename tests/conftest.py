import pytest

from skein.session import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session(cores="4", partitions=4, memory="4g", app="tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
