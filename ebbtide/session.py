"""SparkSession with the settings the operators were tuned for.

Anything given by spark-submit wins; the ``EBBTIDE_*`` variables are for plain ``python -m`` runs.
"""

from __future__ import annotations

import os

from pyspark import SparkConf
from pyspark.sql import SparkSession


def build_session(app_name: str = "ebbtide") -> SparkSession:
    submitted = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    defaults = {
        "spark.master": os.getenv("EBBTIDE_MASTER", "local[*]"),
        "spark.driver.memory": os.getenv("EBBTIDE_DRIVER_MEMORY", "4g"),
        # AQE merges small shuffle partitions and adds none, so the initial number is no smaller than Spark's own.
        "spark.sql.shuffle.partitions": os.getenv("EBBTIDE_SHUFFLE_PARTITIONS", "200"),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # Recording a Python call site for every column expression slows down plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in defaults.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    # Dates are compared as calendar days, so every node has to agree on the zone.
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    if os.getenv("EBBTIDE_ENABLE_HIVE") == "1":
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
