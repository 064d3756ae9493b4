import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from menulake.session import BASE_CONF
    b = (SparkSession.builder.master("local[*]").appName("menulake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "6g"))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="menulake-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="menulake-test-")
