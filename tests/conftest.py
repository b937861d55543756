import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sitepulse.session import get_session  # noqa: E402

READINGS = "ID bigint, DateTime timestamp_ntz, Junction bigint, Vehicles bigint"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    """Make readings from (ID, clock text or hours since 2024-01-01, Junction, Vehicles) tuples."""

    def make(*rows):
        def clock(value):
            if isinstance(value, str):
                return datetime.fromisoformat(value)
            return datetime(2024, 1, 1) + timedelta(hours=value)

        return spark.createDataFrame([(i, clock(at), j, v) for i, at, j, v in rows], READINGS)

    return make


def values(frame, *columns):
    """Rows as sorted tuples of the given columns."""
    return sorted(tuple(row[c] for c in columns) for row in frame.collect())
