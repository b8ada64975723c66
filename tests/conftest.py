from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

SF_SMALL = "/root/testdata/sf0.001"


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("ebbtide-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ebbtide-test-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ebbtide-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
