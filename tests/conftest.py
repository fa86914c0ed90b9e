import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from salesflow.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", spark__sql__shuffle__partitions=4,
                          spark__ui__enabled="false", spark__driver__memory="6g",
                          spark__ui__showConsoleProgress="false",
                          spark__python__sql__dataFrameDebugging__enabled="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def values(df, *order):
    """Rows as tuples, sorted, for comparison."""
    rows = [tuple(r) for r in df.select(*order).collect()] if order else [
        tuple(r) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
