import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from epicentre.session import build_session

    spark = build_session("local[4]", app="epicentre-tests", conf={"spark.sql.shuffle.partitions": "8"})
    # tests set their own shared folder only where the session has none
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="epicentre-tests-"))
    yield spark


@pytest.fixture(scope="session")
def sf001():
    return SF001
