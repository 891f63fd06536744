import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from healthmart.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
# The shipped disease/symptom profile CSV (349 rows); the golden tests run
# when this points to it and are skipped otherwise.
DISEASE_CSV = os.environ.get("HEALTHMART_DISEASE_CSV", "")


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="healthmart-tests", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hm-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="hm-test-")
