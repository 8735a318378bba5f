import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from stayflow.session import get_session

    s = get_session(
        master="local[4]", app_name="stayflow-tests", shuffle_partitions=8,
        extra={"spark.driver.memory": "4g",
               "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="stayflow-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stayflow-ckpt-"))
    yield s
