from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package as well
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

from windrow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", shuffle_partitions=8, memory="8g", name="windrow-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def samples(spark):
    """Two sessions with overlapping clocks, two bouts of a label, filler rows, NaN and null."""
    nan = float("nan")
    rows = [
        (1, "protocol", 0.00, 1, 1.0, 5.0, None), (1, "protocol", 1.00, 1, nan, 5.0, 1.0),
        (1, "protocol", 4.99, 1, 3.0, 5.0, 2.0), (1, "protocol", 5.00, 1, 4.0, 5.0, 3.0),
        (1, "optional", 0.50, 1, 2.0, 5.0, 4.0), (1, "optional", 100.0, 1, 9.0, 5.0, 5.0),
        (1, "protocol", 6.00, 0, 8.0, 5.0, 6.0), (2, "protocol", 3.00, 1, 7.0, 5.0, None),
        (2, "protocol", 3.00, 2, 6.0, 5.0, 8.0), (2, "protocol", 3.00, 0, None, None, None),
    ]
    return spark.createDataFrame(rows, "subject int, session string, t double, label int, "
                                       "m1 double, m2 double, m3 double")


def rows_of(df):
    return [tuple(r) for r in df.collect()]
