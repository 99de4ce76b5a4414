"""The shared folder of a cluster, and tables staged in it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. In one process, as in tests, one is made where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="korvane-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back. This cuts the lineage; a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._korvane_path = path
    _staged.append(path)
    return out


#: Folders that this driver has staged. Results read them lazily, so nothing removes them by itself.
_staged: list[str] = []


def drop_all_staged(spark: SparkSession) -> None:
    """Remove all tables of stage(), once their results have been written or collected."""
    while _staged:
        remove(spark, _staged.pop())


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end: write or collect the results before it."""
    before = len(_staged)
    try:
        yield
    finally:
        while len(_staged) > before:
            remove(spark, _staged.pop())


def drop_staged(df: DataFrame) -> None:
    """Remove a table of stage() that nothing reads any more."""
    remove(df.sparkSession, df._korvane_path)
    if df._korvane_path in _staged:
        _staged.remove(df._korvane_path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no such folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(at)) if system.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at))
