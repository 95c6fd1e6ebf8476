"""Local session for tests and comparisons."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablewright")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", "/tmp/tablewright-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
