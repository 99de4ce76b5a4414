"""What the operators of this subpackage share: the shared folder, staged tables, blocked comparisons, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..storage import drop_staged, new_path, shared_dir, stage

__all__ = ["LOWER", "components", "crc_mod", "drop_staged", "finite_vector", "forest", "named_groups", "new_path", "own_columns", "shared_dir", "stage", "task_rows"]

#: bytes.translate table that lower-cases A-Z and leaves every other byte.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def own_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename columns of df that an operator is about to add: the operator's column wins, the input's gets the suffix _input."""
    taken = {c.lower() for c in df.columns}
    for c in df.columns:
        if c.lower() in {n.lower() for n in names}:
            new = f"{c}_input"
            while new.lower() in taken:
                new += "_"
            taken.add(new.lower())
            df = df.withColumnRenamed(c, new)
    return df


def crc_mod(column: str, n: int):
    """crc32 of the id as text, modulo n; null ids give null."""
    return F.crc32(F.col(column).cast("string")) % n


def finite_vector(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def task_rows(df: DataFrame, key: list[str], item: str, limit: int) -> DataFrame:
    """Deal rows out into bounded tasks for comparisons within a key.

    A key of up to `limit` rows is one task (chunks 0, 0). A larger one is cut by the hash of `item` into chunks of about
    `limit` rows, and each pair of chunks is a task, so that every pair of rows meets in one task at least and no task
    holds more than about two chunks. Adds _i and _j, the chunks of the task, and _own, the row's own chunk.
    """
    hot = df.groupBy(*key).count().where(F.col("count") > limit).select(*key, F.ceil(F.col("count") / limit).cast("int").alias("_chunks"))
    rows = df.join(hot, key, "left").withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))
    own = F.pmod(F.xxhash64(F.col(item), F.lit(7)), F.col("_chunks")).cast("int")
    return (
        rows.withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_chunks", "_other")
    )


def forest(n: int, near) -> list[tuple[int, int]]:
    """A spanning forest of n items. near(i, rest) says which of the items `rest` link with item i.

    Breadth-first: each item is held once against the items not reached yet, so a dense group costs little and never
    gives more than n - 1 edges.
    """
    rest, edges, queue = np.arange(n), [], []
    while len(rest) or queue:
        if queue:
            i = queue.pop()
        else:
            i, rest = int(rest[0]), rest[1:]
        if not len(rest):
            break
        hit = near(i, rest)
        if hit.any():
            found = rest[hit].tolist()
            edges += [(i, k) for k in found]
            queue += found
            rest = rest[~hit]
    return edges


def named_groups(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root, component) for each of nodes (node, least): its group under edges (a, b), named by the smallest node, and the group's smallest `least`."""
    found = components(edges)
    rooted = stage(nodes.join(found, "node", "left").select("node", "least", F.coalesce("component", "node").alias("root")), "groups-rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return stage(rooted.join(named, "root").select("node", "root", "component"), "groups-named")
