import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from urbanloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """DataFrame from a DDL schema and tuples."""

    def make(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return make


def values(df, *columns):
    """Rows as tuples, in column order given."""
    return [tuple(row[name] for name in columns) for row in df.collect()]
