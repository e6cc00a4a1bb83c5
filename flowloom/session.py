"""A Spark session for tests and benchmarks on one machine."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 4, memory: str = "8g") -> SparkSession:
    """Local session; a cluster brings its own session and its own sizes."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flowloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
