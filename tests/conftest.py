import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="stayline-tests", shuffle_partitions=4)
    yield s


@pytest.fixture
def blocked(spark):
    """Force the two-level (skew-safe) scan for one test."""
    spark.conf.set("stayline.scan.mode", "blocked")
    yield
    spark.conf.unset("stayline.scan.mode")


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
