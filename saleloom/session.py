"""Spark session with the settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Adaptive execution picks the number of reduce tasks, splits skewed joins and demotes bad broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(app: str = "saleloom", shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """Session with ``SETTINGS``; the master comes from spark-submit or the environment.

    Give ``shuffle_partitions`` generously on a cluster (2-3 per core, or the shuffled bytes over 128 MB):
    adaptive execution merges partitions that turn out small but cannot split plain aggregations.
    """
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
