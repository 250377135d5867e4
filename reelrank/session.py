"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Sizes are per task, so they hold on any cluster. The number of shuffle partitions is an
# upper bound that adaptive execution coalesces; it is left to the caller's configuration.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def spark_session(app_name: str, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` uses ``__`` for dots in names."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
