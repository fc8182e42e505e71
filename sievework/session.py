"""The session for local runs; on a cluster the caller's session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sievework")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
