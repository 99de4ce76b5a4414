"""Nearest comparables under a composite distance, and values estimated from them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import stage

#: Fixed values of the metric.
REACH_M = 2000.0
GROUND_UNIT_M = 500.0
NEIGHBOURS = 8
WEIGHTS = {"ground": 1.0, "lot": 1.0, "floor": 1.0, "dwellings": 1.0, "use": 1.5}
SAME_CLASS, DIFFERENT_CLASS = 0.35, 1.0


def use_distance(a: Column, b: Column) -> Column:
    """0 for equal codes, less for the same class (first digit) than for different ones; missing counts as different."""
    return F.when(a == b, 0.0).when(F.substring(a, 1, 1) == F.substring(b, 1, 1), SAME_CLASS).otherwise(DIFFERENT_CLASS)


#: Radii searched in turn, as shares of the reach.
RINGS = (0.125, 0.25, 0.5, 1.0)
SIZES = ("lot", "floor", "dwellings")


def nearest(subjects: DataFrame, k: int = NEIGHBOURS, reach: float = REACH_M) -> DataFrame:
    """For each subject its k nearest with a value: (key, other, distance, rank, o_value, o_lot, o_floor, o_dwellings).

    subjects: key, x, y, lot, floor, dwellings, use, value. Others lie within `reach` on the ground, the subject itself
    is none; the smaller key comes first at equal distances. Subjects without a place have none; keys are distinct.

    The composite distance is never less than its ground part, nor than any other. So a subject with k others nearer than a
    ring's radius by the composite distance has found its k nearest within that ring, and only the rest look farther. Cells
    of the ring's radius and their eight neighbours hold all candidates; where the ring is smaller than the distance of
    uses of different classes, a cell is one class's, and where it is smaller than that of different codes, one code's.
    Pairs carry keys and distance only. No side is broadcast: Spark guesses its size by the file's and not by its copies.
    """
    log = lambda c: (F.log1p(F.col(c).cast("double")) / math.log(2)).alias(f"l_{c}")
    placed = stage(subjects.where("x IS NOT NULL AND y IS NOT NULL").select("key", "x", "y", *[log(c) for c in SIZES], "use", "value", *SIZES), "comparables")
    others = placed.where("value IS NOT NULL").select(F.col("key").alias("o_key"), *[F.col(c).alias(f"o_{c}") for c in ("x", "y", "use", *[f"l_{c}" for c in SIZES])])
    mine = placed.select("key", "x", "y", "use", *[f"l_{c}" for c in SIZES])
    ground = F.hypot(F.col("x") - F.col("o_x"), F.col("y") - F.col("o_y"))
    parts = {"ground": ground / GROUND_UNIT_M} | {c: F.coalesce(F.abs(F.col(f"l_{c}") - F.col(f"o_l_{c}")), F.lit(1.0)) for c in SIZES} | {"use": use_distance(F.col("use"), F.col("o_use"))}
    total = F.lit(0.0)
    # What needs no root comes first: most candidates are refused by their ground and lot alone.
    square = lambda c: (F.col(c) - F.col(f"o_{c}")) * (F.col(c) - F.col(f"o_{c}"))
    plain = (square("x") + square("y")) / GROUND_UNIT_M**2 * WEIGHTS["ground"] + F.coalesce((F.col("l_lot") - F.col("o_l_lot")) * (F.col("l_lot") - F.col("o_l_lot")), F.lit(1.0)) * WEIGHTS["lot"]
    for name, part in parts.items():
        total = total + F.lit(WEIGHTS[name]) * part * part
    found, rest = [], mine
    n = int(subjects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for ring in RINGS:
        radius = reach * ring
        bound = radius / GROUND_UNIT_M * WEIGHTS["ground"] ** 0.5
        cell = lambda c, radius=radius: F.floor(F.col(c) / radius)
        # What lies farther apart by its use alone than the bound is not among the ring's candidates; a missing use differs from all.
        apart = lambda u: WEIGHTS["use"] ** 0.5 * u > bound + 1e-9  # noqa: B023, E731
        same = ring < 1 and (lambda c: F.col(c) if apart(SAME_CLASS) else F.substring(c, 1, 1))
        split = bool(same) and apart(DIFFERENT_CLASS)
        kind = (lambda c: same(c)) if split else (lambda c: F.lit(""))  # noqa: E731, B023
        left = rest.withColumn("_cx", F.explode(F.sequence(cell("x") - 1, cell("x") + 1))).withColumn("_cy", F.explode(F.sequence(cell("y") - 1, cell("y") + 1))).withColumn("_use", kind("use"))
        right = others.withColumn("_cx", cell("o_x")).withColumn("_cy", cell("o_y")).withColumn("_use", kind("o_use"))
        near = square("x") + square("y") <= radius * radius * (1 + 1e-9)
        near = near & (plain <= bound * bound * (1 + 1e-9)) if ring < 1 else near
        on = ["_cx", "_cy", "_use"]
        pairs = left.repartition(n, *on).join(right.repartition(n, *on).hint("shuffle_hash"), on).where((F.col("key") != F.col("o_key")) & near & (ground <= radius)).select("key", "o_key", F.sqrt(total).alias("distance"))
        if ring < 1:
            pairs = pairs.where(F.col("distance") <= bound)
        w = Window.partitionBy("key").orderBy("distance", "o_key")
        best = stage(pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k), "comparables-ring")
        if ring == 1:
            found.append(best)
            break
        done = best.where(F.col("rank") == k).select("key")
        found.append(best.join(done.hint("merge"), "key", "left_semi"))
        rest = stage(rest.join(done.hint("merge"), "key", "left_anti"), "comparables-rest")
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    values = placed.select(F.col("key").alias("o_key"), *[F.col(c).alias(f"o_{c}") for c in ("value", *SIZES)])
    return every.join(values.hint("merge"), "o_key").select("key", F.col("o_key").alias("other"), "distance", "rank", "o_value", *[f"o_{c}" for c in SIZES])


def value_cascade(pairs: DataFrame, subjects: DataFrame) -> DataFrame:
    """(key, n, estimate, basis): the median value a dwelling, else a unit of floor, else of land, times the subject's own size."""
    per = lambda size: F.when(F.col(size) > 0, F.col("o_value") / F.col(size))
    medians = pairs.groupBy("key").agg(F.count("*").alias("n"), F.percentile(per("o_dwellings"), 0.5).alias("_d"), F.percentile(per("o_floor"), 0.5).alias("_f"), F.percentile(per("o_lot"), 0.5).alias("_l"))
    rows = subjects.join(medians.hint("merge"), "key", "left")
    by = [("per_dwelling", F.when(F.col("dwellings") > 0, F.col("_d") * F.col("dwellings"))), ("per_floor_area", F.when(F.col("floor") > 0, F.col("_f") * F.col("floor"))), ("per_land_area", F.when(F.col("lot") > 0, F.col("_l") * F.col("lot")))]
    basis = F.lit("none")
    for name, c in reversed(by):
        basis = F.when(c.isNotNull(), name).otherwise(basis)
    return rows.select("key", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(*[c for _, c in by]).alias("estimate"), basis.alias("basis"))
