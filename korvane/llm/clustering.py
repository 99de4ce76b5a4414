"""Centroid clustering: plain Lloyd rounds in exact integers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import finite_vector, stage

#: Vectors that a task works on at once.
ROWS = 4096


def most(dim: int) -> int:
    """Components below this in size have squared distances that fit a long."""
    return math.isqrt(((1 << 63) - 1) // dim) // 2


def quantised(vectors: DataFrame, dim: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): vectors of dim finite components as floor(scale * component), where all of them fit."""
    x = F.transform(F.col("v"), lambda c: F.floor(c * scale))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fits = finite_vector(F.col("v")) & (F.size("v") == dim) & F.forall("v", lambda c: F.abs(c * scale) < most(dim))
    return rows.where(F.coalesce(fits, F.lit(False))).select("id", F.transform(x, lambda c: c.cast("int")).alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors with the k smallest SHA-256 of 'seed:id', in the order of those; ties go to the smaller vector. A null id is empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    chosen = rows.select(F.sha2(name, 256).alias("order"), "x").orderBy("order", "x").limit(k).collect()
    return np.array([r["x"] for r in chosen], dtype=np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the number of its nearest centroid and the squared distance, all in int64. The lowest number wins a tie."""
    cluster, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for a in range(0, len(x), ROWS):
        part = x[a : a + ROWS]
        squares = np.stack([((part - c) ** 2).sum(1) for c in centroids], axis=1)
        cluster[a : a + ROWS] = squares.argmin(1)
        distance[a : a + ROWS] = squares.min(1)
    return cluster, distance


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floor of the mean of each one's vectors, as exact integers; one without vectors stays.

    Each task sums its vectors by centroid and dimension; a grouping adds the tasks' sums, and len(centroids) times the
    dimension rows reach the driver, however many vectors there are.
    """
    k, dim = centroids.shape
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for pdf in batches:
            if len(pdf):
                x = matrix(pdf["x"])
                cluster, _ = nearest(x, shared.value)
                n += np.bincount(cluster, minlength=k)
                for c in range(k):
                    s[c] += x[cluster == c].sum(0)
        met = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": np.repeat(met, dim), "dim": np.tile(np.arange(dim), len(met)), "n": np.repeat(n[met], dim), "s": s[met].ravel()})

    parts = rows.select("x").mapInPandas(sums, "cluster int, dim int, n long, s long")
    found = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect()
    shared.unpersist()
    out = centroids.copy()
    for r in found:
        out[r["cluster"], r["dim"]] = int(r["s"]) // int(r["n"])
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) for each of rows (id, x)."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cluster, distance = nearest(matrix(pdf["x"]), shared.value)
                yield pd.DataFrame({"id": pdf["id"], "cluster": cluster, "distance": distance})

    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, cluster int, distance long")


def lloyd(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: str = "3", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) for each vector that takes part.

    Components become floor(scale * x). The centroids start as the k vectors of smallest SHA-256 of 'seed:id'. A round
    sends each vector to its nearest centroid (squared Euclidean; ties to the smaller number) and moves each centroid to
    the floor of its vectors' mean; one without vectors stays. After the rounds the vectors are assigned once more:
    distance is squared, cluster_inertia and inertia are its sums over the cluster and over all, and centroid is the
    cluster's final one. Rounds end early where no centroid moved, as none would in those left.

    Vectors that are null, of another length, hold null or non-finite components, or components too large for a long to
    hold their distances (185 000 and more in size at the default scale) take no part and have no row. Repeated rows and ids count and come back as
    often as they are there; a null id stands as empty text in the start and comes back null. Fewer than k vectors are
    fewer centroids, and an empty table gives an empty result. Other columns are not read.
    """
    rows = stage(quantised(vectors, dim, scale, id_col, vector_col), "lloyd-vectors")
    centroids = first_centroids(rows, k, seed).reshape(-1, dim)
    schema = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    if not len(centroids):
        none = rows.sparkSession.createDataFrame([], schema)
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).join(none, "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
    for _ in range(rounds):
        before, centroids = centroids, moved(rows, centroids)
        if (before == centroids).all():
            break
    out = assigned(rows, centroids)
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    total = sum(sums.values())
    of = rows.sparkSession.createDataFrame([(c, s, total, centroids[c].tolist()) for c, s in sorted(sums.items())], schema)
    # One row a centroid.
    return out.join(F.broadcast(of), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_sha256(centroid: Column) -> Column:
    """Lower-case hex SHA-256 of the components in decimal, joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)


def op13_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lloyd over all embeddings: 8 centroids, 10 rounds, 64 components, scale 1024."""
    out = lloyd(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", centroid_sha256(F.col("centroid")).alias("centroid_sha256"))


def lloyd_sql(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: str = "3") -> str:
    """The same as SQL, a pair of tables a round; d counts dimensions from 1."""
    near = "SELECT vec_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (SELECT v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM v JOIN {c} c USING (d) GROUP BY ALL) GROUP BY vec_id"
    parts = [
        f"""good AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (SELECT vec_id, unnest(range(1, {dim + 1})) AS d, CAST(floor({scale} * unnest(e)) AS BIGINT) AS x FROM good
), c0 AS MATERIALIZED (SELECT n.cluster, v.d, v.x FROM (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster FROM good) n JOIN v USING (vec_id) WHERE n.cluster < {k})"""
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(c=f'c{r}')})")
        parts.append(
            f"c{r + 1} AS MATERIALIZED (SELECT o.cluster, o.d, CASE WHEN s.n IS NULL THEN o.x ELSE CAST((s.s - ((s.s % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x"
            f" FROM c{r} o LEFT JOIN (SELECT a.cluster, v.d, CAST(sum(v.x) AS BIGINT) AS s, count(*) AS n FROM a{r} a JOIN v USING (vec_id) GROUP BY ALL) s USING (cluster, d))"
        )
    parts.append(f"a AS MATERIALIZED ({near.format(c=f'c{rounds}')})")
    return (
        "WITH "
        + ", ".join(parts)
        + f", h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)"
        + " SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a JOIN h USING (cluster)"
    )


OP13_SQL = lloyd_sql()
