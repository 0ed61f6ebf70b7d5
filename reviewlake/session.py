"""A session with the settings the library is developed against."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, partitions: int | None = None, memory: str = "12g") -> SparkSession:
    """Local session for tests and the bench. On a cluster, use the session the cluster gives you."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reviewlake")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
