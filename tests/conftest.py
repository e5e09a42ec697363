from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tracebook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        "tests", 4, spark__sql__shuffle__partitions="4", spark__sql__warehouse__dir=str(warehouse)
    )
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as tuples in a stable order."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
