import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from pulse.session import configure
    b = (SparkSession.builder.master("local[4]").appName("pulse-tests")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("FATAL")
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pulse-test-ckpt-"))
    configure(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from pulse.session import shared_dir
    return lambda name: shared_dir(spark, "tests", name)
