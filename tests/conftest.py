import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cohortflow.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        # Tests only: the session names no shared checkpoint folder.
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortflow-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def small_pipeline(spark):
    from cohortflow.plans import catalog
    return catalog.pipeline(spark, SF_SMALL)
