"""Session helper for tests, the bench and ad-hoc runs. On a cluster, bring your own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "accountlens", memory: str = "12g",
                  shuffle_partitions: int = 8, warehouse: str | None = None,
                  shared: str | None = None) -> SparkSession:
    """``shared``: the folder for tables in between, ``spark.checkpoint.dir``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
