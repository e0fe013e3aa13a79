import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from basketflow.session import get_spark
    s = get_spark("local[*]", app="basketflow-tests", shuffle_partitions=8,
                  extra={"spark.driver.memory": "4g"})
    # Tests run locally: a private checkpoint folder stands in for the cluster's shared one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="basketflow-test-ckpt-"))
    yield s
    s.stop()
