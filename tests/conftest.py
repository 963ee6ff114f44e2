import pytest

from rosterworks.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", 8, 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
