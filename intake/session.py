"""Session settings the jobs are written for. Sizes stay with the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Staging writes a file or two per input split; larger splits, fewer small files.
    "spark.sql.files.maxPartitionBytes": "256m",
    # A staging task writes accepted and rejected rows side by side, with no sort.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.ui.enabled": "false",
}


def builder(app_name: str = "intake") -> SparkSession.Builder:
    made = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        made = made.config(name, value)
    return made
