import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from barrio.session import local_session
    s = local_session(4, 4, app="barrio-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Collect as sorted tuples (optionally a column subset)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()),
                  key=lambda t: tuple((v is not None, v if v is not None else 0) for v in t))
