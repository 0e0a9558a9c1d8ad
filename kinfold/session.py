"""Session construction for stand-alone use and tests; on a cluster the caller's session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "kinfold", cores: int | str = "*", shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution on. Cluster deployments should pass their own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
