"""Session defaults used by tests, benchmarks and command-line runs; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session with the settings every plan here assumes: UTC, adaptive execution, Arrow."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("venueweave")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
