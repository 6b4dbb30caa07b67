import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paymart.session import build_session, work_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="paymart-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder below spark.checkpoint.dir for one test."""
    return work_dir(spark, "test")
