"""Session settings the pipelines expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC makes the ISO-8601 columns independent of where the job runs; adaptive execution sizes the
# shuffles, switches to broadcast joins on measured sizes and splits skewed join partitions. Recording
# the Python call site of every column costs more than building a wide plan.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("haulbook")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
