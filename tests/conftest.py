import pytest

from tests.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(4)
    yield s
    s.stop()
