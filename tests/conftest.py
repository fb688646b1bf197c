import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from poselake.session import local_session

    return local_session("4", 4, "tests")


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df, *columns: sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
