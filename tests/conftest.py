import os

import pytest

from rillmark.session import session

SF_TINY = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "rillmark-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("TEST_DRIVER_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def cut_chunks(spark):
    """Make every scan take the many-chunk path, however small its input."""
    spark.conf.set("spark.rillmark.scan.smallBytes", "0")
    spark.conf.set("spark.rillmark.scan.taskRows", "7")
    yield
    spark.conf.unset("spark.rillmark.scan.smallBytes")
    spark.conf.unset("spark.rillmark.scan.taskRows")
