import pytest

from tests.compare import local_session


@pytest.fixture(scope="session")
def spark():
    from feedweir.session import configure

    return configure(local_session())


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
