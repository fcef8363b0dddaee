import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flightlane.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.log.level": "ERROR"},
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as plain dicts."""
    return lambda df, *order: [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]
