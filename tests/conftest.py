import sys
from pathlib import Path

import pytest
from pyspark import SparkConf
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder
    if SparkConf().get("spark.checkpoint.dir") is None:
        builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session = (
        builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield session
    session.stop()
