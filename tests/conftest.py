import pytest

from rowtide.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="8", partitions=4, app="rowtide-tests")
