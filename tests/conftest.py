import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skewsafe.session import build_session

    scratch = tempfile.mkdtemp(prefix="skewsafe-test-")
    session = build_session(
        app_name="skewsafe-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.checkpoint.dir": os.path.join(scratch, "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tools.compare import duck

    return duck(SF_SMALL)


@pytest.fixture()
def scratch(spark):
    from skewsafe.session import shared_dir

    return shared_dir(spark, "tests")
