import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def bars(spark, tmp_path_factory):
    """The derived bars at sf0.001, written once."""
    from ohlcraft.sources import derived

    path = str(tmp_path_factory.mktemp("bars") / "bars")
    derived.bars(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)
