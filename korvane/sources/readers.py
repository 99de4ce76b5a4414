"""Readers: snapshots, GeoJSON, delimited text, and listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import exists, stage


class MissingDataset(FileNotFoundError):
    """A dataset that a job needs has not been written; the message names what writes it."""


def read_snapshot(spark: SparkSession, root: str, dataset: str, columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """A dataset's Parquet folder, pruned to the columns and partitions asked for."""
    path = f"{root.rstrip('/')}/{dataset}"
    if not exists(spark, path):
        raise MissingDataset(f"{path} is not there: run the job of {dataset} first")
    df = spark.read.parquet(path)
    df = df if where is None else df.where(where)
    return df.select(*columns) if columns else df


def read_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Parquet files of any depth below a pattern, columns matched by name."""
    return spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(pattern)


def union_optional(frames: Sequence[DataFrame | None]) -> DataFrame | None:
    """Those that are there, one under another; a column that one lacks is null in its rows."""
    out = None
    for df in frames:
        if df is not None:
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_geojson(spark: SparkSession, path: str, properties: str, drop: Sequence[str] = (), lines: bool = False) -> DataFrame:
    """A row for each feature: the properties (a DDL schema), and the geometry as its type and its coordinates in JSON.

    A collection is one JSON document, so one task reads a file whole; large layers should come with a feature on each
    line (lines=True), which Spark splits.
    """
    feature = f"struct<properties:struct<{properties}>,geometry:struct<type:string,coordinates:string>>"
    if lines:
        features = spark.read.schema(feature.removeprefix("struct<").removesuffix(">").replace("properties:", "properties ", 1).replace(",geometry:", ", geometry ", 1)).json(path).where("geometry IS NOT NULL OR properties IS NOT NULL").select(F.struct("properties", "geometry").alias("f"))
    else:
        features = spark.read.schema(f"features array<{feature}>").option("multiLine", "true").json(path).select(F.explode("features").alias("f"))
    df = features.select("f.properties.*", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))
    nested = {n: F.to_json(n) for n, t in df.dtypes if t.startswith(("struct", "array", "map"))}
    return df.withColumns(nested).drop(*drop) if nested else df.drop(*drop)


def ring_of(coordinates: Column) -> Column:
    """The outer ring of a polygon's coordinates in JSON, as an array of struct(x, y) without the repeated last point."""
    rings = F.from_json(coordinates, "array<array<array<double>>>")
    ring = F.transform(F.get(rings, 0), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))


def read_delimited(spark: SparkSession, path: str, schema: str, encodings: Sequence[str] = ("UTF-8", "ISO-8859-1"), separator: str = ",", breaks: bool = False) -> DataFrame:
    """Delimited text with a header, in the first of the encodings that decodes all of it. Files are split; only where fields may hold line breaks (breaks=True) does one task read a file whole."""
    for encoding in encodings:
        df = spark.read.schema(schema).option("header", "true").option("sep", separator).option("encoding", encoding).option("multiLine", str(breaks).lower()).csv(path)
        text = [F.coalesce(F.bool_or(F.contains(c, F.lit("�"))), F.lit(False)) for c, t in df.dtypes if t == "string"]
        if encoding == encodings[-1] or not text or not any(df.agg(*[x.alias(f"_{k}") for k, x in enumerate(text)]).first()):
            return df
    return df


def below_header(rows: DataFrame, marks: Sequence[str], index: str = "row_index", cells: str = "cells") -> DataFrame:
    """Rows of a sheet (index, cells array<string>) below its header, which is the first row that holds all the marks; none without such a row."""
    flat = F.transform(cells, lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    wanted = F.array(*[F.lit(m.lower()) for m in marks])
    first = rows.where(F.size(F.array_except(wanted, flat)) == 0).agg(F.min(index)).first()[0]
    return rows.where(F.lit(False)) if first is None else rows.where(F.col(index) > first)


def read_ordered(spark: SparkSession, root: str, dataset: str, order: Sequence[str], columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """read_snapshot in the order of columns, which ends in a unique one."""
    return read_snapshot(spark, root, dataset, columns, where).orderBy(*order)


def unpivot_pairs(df: DataFrame, ids: Sequence[str], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """A crosstab of (value, grade) columns in pairs as long rows: ids, class, value, grade."""
    entries = [F.struct(F.lit(name).alias("class"), F.col(v).cast("string").alias("value"), F.col(g).cast("string").alias("grade")) for name, (v, g) in pairs.items()]
    return df.select(*ids, F.explode(F.array(*entries)).alias("_e")).select(*ids, "_e.*")


def newest_listed(files: DataFrame, path: str = "path", pattern: str = r"((?:19|20)\d{2})") -> DataFrame:
    """Of a list of files the one whose name holds the latest year."""
    year = F.regexp_extract(path, pattern, 1)
    return files.where(year != "").agg(F.max_by(path, F.struct(year, F.col(path))).alias(path), F.max(year).cast("int").alias("year"))


def follow(edges: DataFrame, start: DataFrame, hops: int = 3) -> DataFrame:
    """(url, hop): what can be reached over links (url, target) in at most so many hops, each once at its fewest hops. What a hop finds is staged, so that no hop works out those before it again."""
    seen = last = stage(start.select("url").distinct().withColumn("hop", F.lit(0)), "follow")
    for k in range(hops):
        found = last.join(edges.select("url", "target"), "url").select(F.col("target").alias("url")).distinct().join(seen.select("url"), "url", "left_anti")
        last = stage(found.withColumn("hop", F.lit(k + 1)), "follow")
        seen = seen.unionByName(last)
    return seen
