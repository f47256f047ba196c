import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="veritab-tests-")
    s = (SparkSession.builder.master("local[4]")
         .appName("veritab-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
         .config("spark.local.dir", os.path.join(scratch, "local"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def out_dir(tmp_path):
    return str(tmp_path)
