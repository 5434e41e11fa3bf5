from __future__ import annotations

import os
import sys
import time

import pytest
from pyspark.sql import SparkSession

os.environ["TZ"] = "UTC"  # literal datetimes in tests are UTC
time.tzset()
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def session():
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("monthtide-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def spark(session):
    """The session with the settings the library expects, whatever a test did."""
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    return session
