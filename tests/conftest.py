import pytest

from moodgauge.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Collected rows as sorted plain tuples."""

    def plain(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return plain
