"""A local session for tests, checks and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stocklens")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # plans are built from many expressions; skip recording a call site for each
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", memory))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
