import pytest

from venueweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, memory="6g", partitions=4)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
