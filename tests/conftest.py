from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlane.session import local_session  # noqa: E402
from ledgerlane.sources.schemas import table_schema  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """``make(table, {...}, {...})``: a frame of one ERP table; columns left out are NULL."""

    def build(table: str, *rows: dict):
        schema = table_schema(table)
        unknown = {name for row in rows for name in row} - set(schema.names)
        assert not unknown, unknown
        return spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in rows], schema)

    return build
