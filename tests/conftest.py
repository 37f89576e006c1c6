import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from actimetry.config import get_or_create_session
    extra = {}
    # tests set their own checkpoint root only when the environment names none
    from pyspark import SparkConf
    if not SparkConf().get("spark.checkpoint.dir", None):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="actimetry-test-")
    s = get_or_create_session("local[4]", shuffle_partitions=8, extra=extra)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from actimetry.config import scratch_dir
    return scratch_dir(spark, "test")
