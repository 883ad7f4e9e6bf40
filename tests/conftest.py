import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "6g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # tests own the session, so they may name the shared folder themselves
    from pagewright.session import checkpoint_dir
    checkpoint_dir(s, str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
