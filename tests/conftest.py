import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from regiscope.session import get_session
    s = get_session("regiscope-tests", master="local[4]", shuffle_partitions=4,
                    extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()
