from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from loanlens.session import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
