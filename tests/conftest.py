import pytest

from paperweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false")
    yield session
    session.stop()


@pytest.fixture
def rows():
    def collect(df, *columns):
        return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())

    return collect
