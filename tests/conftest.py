import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from casekit.session import local_session
    wh = tempfile.mkdtemp(prefix="casekit-wh-")
    s = local_session(4, shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": wh,
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from casekit.session import scratch_path
    return scratch_path(spark, "test")
