"""One local session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_session():
    from pyspark.sql import SparkSession
    from meterspark.session import configure
    return configure(
        SparkSession.builder.master("local[8]").appName("meterspark-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate())


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
