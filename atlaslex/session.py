"""Session settings the library is designed for.

Nothing in the library depends on a session made here; any Spark 4 session works. The settings below let Spark re-plan
joins at run time, which the larger shuffles profit from.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A Parquet split is decompressed and stripped of markup in one task: smaller splits keep the task heap flat.
    "spark.sql.files.maxPartitionBytes": "64m",
}


def cluster_session(app_name: str = "atlaslex", partitions: int = 4096, **settings: str) -> SparkSession:
    """Session for ``spark-submit``: master, memory and ``spark.checkpoint.dir`` come from the cluster.

    ``partitions`` is what shuffles start from; Spark merges small ones at run time.
    """
    settings = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)} | settings
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", app_name: str = "atlaslex-local") -> SparkSession:
    """Single-machine session for tests and the bench."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
