import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SMOKE_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("lakeloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():  # only where the environment names none
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from lakeloom.session import scratch_path

    return lambda name: scratch_path(spark, name)
