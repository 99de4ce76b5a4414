"""Streams of events: windows, sessions and merges into tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import latest_per_key
from ..storage import exists, names, remove


def timed(events: DataFrame, late: str) -> DataFrame:
    """A stream with its watermark, which needs timestamps with a zone; tables as they are."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def windowed(events: DataFrame, window: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and event type. Works on streams, with a watermark, and on tables."""
    rows = timed(events, late)
    grouped = rows.groupBy(F.window("ts", window, slide) if slide else F.window("ts", window), "event_type")
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user, parted by quiet of at least the gap."""
    rows = timed(events, late)
    grouped = rows.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return grouped.select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n", "total")


def deduplicated(events: DataFrame, keys: Sequence[str], late: str = "10 minutes") -> DataFrame:
    """The first arrival of each key; state is forgotten once the watermark has passed."""
    if events.isStreaming:
        return timed(events, late).dropDuplicatesWithinWatermark(list(keys))
    return latest_per_key(events, keys, [F.asc("ts"), F.asc("event_id")])


#: Parts that a merged table is cut into by its keys.
BUCKETS = 64


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """The version of a merged table, and the folder that each of its buckets lies in. Version 0 is a table without rows."""
    done = [n for n in names(spark, path) if n.startswith("manifest-") and exists(spark, f"{path}/{n}/_SUCCESS")]
    if not done:
        return 0, {}
    newest = max(done, key=lambda n: int(n.rpartition("-")[2]))
    rows = spark.read.schema("bucket int, folder string").json(f"{path}/{newest}").collect()  # BUCKETS rows at most
    return int(newest.rpartition("-")[2]), {r["bucket"]: r["folder"] for r in rows}


def read_merged(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The rows of a merged table, of some of its buckets if asked; None while it has none."""
    _, at = manifest(spark, path)
    folders = [f"{path}/{folder}/_bucket={b}" for b, folder in sorted(at.items()) if buckets is None or b in buckets]
    return spark.read.parquet(*folders) if folders else None


def merge_into(path: str, keys: Sequence[str], buckets: int = BUCKETS):
    """A foreachBatch function that keeps the newest row of each key in a table that read_merged reads.

    The keys' hash says the bucket. A batch rewrites only the buckets it touches, into a new folder; a manifest that names
    each bucket's folder, written last, makes it the table. A crash leaves the old manifest and its folders whole, and the
    batch that Spark runs again gives the same rows. Folders that neither this nor the last version names are removed.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]  # `buckets` numbers at most
        if not touched:
            return
        version, at = manifest(spark, path)
        old = read_merged(spark, path, touched)
        if old is not None:
            rows = rows.unionByName(old.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
        folder = f"data-{uuid.uuid4().hex}"
        latest_per_key(rows, keys, [F.desc("ts"), F.desc("event_id")]).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{path}/{folder}")
        now = at | dict.fromkeys(touched, folder)
        spark.createDataFrame(sorted(now.items()), "bucket int, folder string").coalesce(1).write.mode("overwrite").json(f"{path}/manifest-{version + 1}")
        for name in names(spark, path):
            if name.startswith("data-") and name not in {*now.values(), *at.values()}:
                remove(spark, f"{path}/{name}")

    return merge
