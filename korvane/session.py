"""Session settings that the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution splits skewed joins and fits partitions to what stages really produce; UTC keeps dates alike everywhere.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(name: str = "korvane", **more: str) -> SparkSession:
    """A session with SETTINGS; more overrides them. Masters and sizes are the cluster's business."""
    return SparkSession.builder.appName(name).config(map=SETTINGS | more).getOrCreate()
