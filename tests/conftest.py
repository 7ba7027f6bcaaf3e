import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pulse.session import build_session
    s = build_session("local[*]", 8, app_name="pulse-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as sorted tuples (order-insensitive comparison)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
