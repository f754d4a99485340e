import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory):
    """A data directory with the test tables' columns and no rows."""
    source = "/root/testdata/sf0.001"
    if not os.path.isdir(source):
        pytest.skip("no test data")
    folder = tmp_path_factory.mktemp("empty")
    for f in os.listdir(source):
        spark.read.parquet(f"{source}/{f}").limit(0).write.parquet(str(folder / f))
    return str(folder)
