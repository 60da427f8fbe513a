"""Session defaults for local runs and tests; on a cluster, use the session it gives."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "touchline") -> SparkSession:
    return (SparkSession.builder.master(f"local[{cores}]").appName(app)
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", "12g")
            .config("spark.ui.enabled", "false")
            .config("spark.sql.legacy.parquet.nanosAsLong", "false")
            .getOrCreate())
