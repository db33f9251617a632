from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from envspark.plans.session import tune

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "6g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def readings(spark):
    """A small table of readings, cached for the tests."""
    from envspark.sources.readings import load_readings

    return load_readings(spark, SMALL).cache()
