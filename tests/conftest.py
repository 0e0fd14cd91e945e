from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tenura.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA


def as_rows(df):
    """Rows as dicts in a stable order."""
    names = sorted(df.columns)
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
