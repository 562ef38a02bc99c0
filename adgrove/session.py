"""Spark session settings used by the tests, the bench and the checks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: str | None = None, partitions: int | None = None) -> SparkSession:
    """Single-JVM session. On a cluster, submit with your own settings; nothing in the library depends on these."""
    n = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName("adgrove")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
