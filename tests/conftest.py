import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sensorgrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]",
        "tests",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__default__parallelism="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect as a list of tuples, sorted."""

    def collect(df, *names):
        df = df.select(*names) if names else df
        return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is None, str(v)) for v in t])

    return collect
