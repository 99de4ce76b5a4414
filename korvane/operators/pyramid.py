"""Quadkey pyramids and cuts of the plane into cells of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def roll_up(cells: DataFrame, key: str, measures: dict[str, str], coarsest: int, finest: int) -> DataFrame:
    """Sums, maxima and so on of every level from `finest` to `coarsest`: (zoom, quadkey, measures).

    measures: column -> sum, max, min or bool_or. Each level is made from the finer one's rows in a single aggregation: a
    key stands for all its prefixes. The finest level is aggregated first, so that what is multiplied is one row for each
    cell and not one for each input row.
    """
    agg = lambda src: [getattr(F, how)(src(name)).alias(name) for name, how in measures.items()]
    base = cells.groupBy(F.substring(key, 1, finest).alias("_key")).agg(*agg(F.col))
    levels = base.withColumn("zoom", F.explode(F.sequence(F.lit(coarsest), F.lit(finest))))
    return levels.groupBy("zoom", F.substring(F.col("_key"), F.lit(1), F.col("zoom")).alias("quadkey")).agg(*agg(F.col))


def adaptive_cut(keys: DataFrame, key: str, budget: int, coarsest: int, finest: int) -> DataFrame:
    """The cells of a cut: (quadkey, zoom, n). A cell is the largest that holds no more than `budget` keys.

    A cell of the finest level is kept whatever it holds. Every key lies under just one cell of the cut: a cell is in the
    cut if it is within budget (or finest) and its parent is not (or it is coarsest).
    """
    counted = roll_up(keys.withColumn("n", F.lit(1).cast("long")), key, {"n": "sum"}, coarsest, finest)
    parents = counted.select((F.col("zoom") + 1).alias("zoom"), F.col("quadkey").alias("_parent"), F.col("n").alias("_above"))
    child = counted.withColumn("_parent", F.expr("substring(quadkey, 1, zoom - 1)"))
    with_above = child.join(parents, ["zoom", "_parent"], "left")
    fits = (F.col("n") <= budget) | (F.col("zoom") == finest)
    first = (F.col("zoom") == coarsest) | (F.col("_above") > budget)
    return with_above.where(fits & first).select("quadkey", "zoom", "n")


def require_in_cut(df: DataFrame, key: str, cut: DataFrame, coarsest: int, finest: int, what: str) -> DataFrame:
    """df with its cells, or an error that counts the rows with a key under no cell and names three of the keys."""
    placed = cell_in_cut(df, key, cut, coarsest, finest)
    lost = placed.where(F.col("cell").isNull() & F.col(key).isNotNull())
    some = [r[0] for r in lost.select(key).distinct().orderBy(key).limit(3).collect()]
    if some:
        raise ValueError(f"{what}: {lost.count()} rows outside the cut, such as {', '.join(some)}")
    return placed


def cell_bridge(lots: DataFrame, key: str, cut: DataFrame, borough: str, coarsest: int, finest: int) -> DataFrame:
    """(borough, cell): which cells of a cut hold lots of which borough, each pair once; lots outside the cut or without a borough count in none."""
    return cell_in_cut(lots, key, cut, coarsest, finest).where(F.col("cell").isNotNull() & F.col(borough).isNotNull()).select(borough, "cell").distinct()


def cell_in_cut(df: DataFrame, key: str, cut: DataFrame, coarsest: int, finest: int) -> DataFrame:
    """df with the cell of the cut that each key lies under, as `cell`; null outside.

    Each distinct key's prefixes are looked up in the cut, of which one at most is there, and the rows meet their key's
    cell by the key itself; a null key lies under none.
    """
    prefix: list[Column] = [F.substring("_key", 1, z) for z in range(coarsest, finest + 1)]
    keys = df.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct()
    found = keys.withColumn("cell", F.explode(F.array_distinct(F.array(*prefix)))).join(cut.select(F.col("quadkey").alias("cell")), "cell", "left_semi")
    return df.join(found, F.col(key) == F.col("_key"), "left").drop("_key")
