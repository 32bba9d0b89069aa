import pytest

from fadecast.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(4)
    yield s
    s.stop()
