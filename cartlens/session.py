"""Session defaults, and the shared folder for data that must outlive a task."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# No metric depends on these for its result: dates and hours are taken in UTC by the expressions themselves.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Start from many shuffle partitions (spark.sql.shuffle.partitions) and let AQE merge them to this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Rows filed under a few folders, such as event types, are written without sorting them first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def builder(app_name: str = "cartlens") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for key, value in RECOMMENDED.items():
        b = b.config(key, value)
    return b


def shared_folder(spark: SparkSession) -> str:
    """A new, unused path in the folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; where that is unset, it is the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/cartlens-{uuid.uuid4().hex}"
