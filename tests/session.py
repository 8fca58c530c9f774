"""A local Spark session for tests and tools."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: str | int = 8) -> SparkSession:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Python workers import the package from here.
    os.environ["PYTHONPATH"] = root + os.pathsep + os.environ.get("PYTHONPATH", "")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("mailloom")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
