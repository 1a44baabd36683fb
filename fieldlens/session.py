"""Session defaults. On a cluster the submitted configuration wins; these fill gaps."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and the local benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fieldlens")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
