import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from navspark.schemas import NAV_SCHEMA  # noqa: E402
from navspark.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="navspark-tests")
    yield s


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


# Golden NAV micro-fixture: NULL NAV on an end date, zero base, single row,
# month edge with a gap in days.
GOLDEN_ROWS = [
    ("A", "1", "2024-01-01", 10.0),
    ("A", "1", "2024-01-02", 11.0),
    ("A", "1", "2024-02-01", 12.0),
    ("B", "2", "2024-01-01", 5.0),
    ("B", "2", "2024-01-03", None),
    ("C", "3", "2024-01-03", 0.0),
    ("C", "3", "2024-01-04", 4.0),
    ("D", "4", "2024-01-04", 4.0),
]


@pytest.fixture(scope="session")
def golden(spark):
    rows = [(d(day), nav, code, name) for name, code, day, nav in GOLDEN_ROWS]
    return spark.createDataFrame(rows, NAV_SCHEMA)
