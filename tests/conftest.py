import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from encore.session import build_session
    session = build_session("local[4]", app_name="encore-tests", shuffle_partitions=8,
                            conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="encore-wh-"),
                                  "spark.checkpoint.dir": tempfile.mkdtemp(prefix="encore-ckpt-")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_small():
    from compare import duck_connection
    return duck_connection(SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="encore-test-")
