from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from coffer.session import drop_scratch, ledger_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = ledger_session("coffer-tests", master="local[8]", cores=4)
    yield session
    drop_scratch(session)
    session.stop()


def rows(df, *order):
    """Rows as tuples, in the given order or sorted by their text."""
    if order:
        return [tuple(r) for r in df.orderBy(*order).collect()]
    return sorted((tuple(r) for r in df.collect()), key=repr)
