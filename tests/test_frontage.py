"""Street inside parcels of any shape, and addresses on lots and their pieces."""

import numpy as np
import pytest
from korvane.operators import frontage
from pyspark.sql import functions as F


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


RING = "array<struct<x:double,y:double>>"


def test_street_inside_any_shape(spark):
    ell = ring((0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10))
    cases = [((-5, 2, 15, 2), 10), ((-5, 8, 15, 8), 4), ((2, -3, 2, 20), 10), ((0, 12, 12, 0), 4 * 2**0.5), ((1, 1, 3, 3), 8**0.5), ((20, 20, 30, 30), 0), ((5, 5, 6, 9), 0), ((0, 10, 10, 0), 2 * (4 * 2**0.5)), ((3, 3, 3, 3), 0)]
    rows = [(k, *map(float, s), ell) for k, (s, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, f"k int, ax double, ay double, bx double, by double, ring {RING}")
    got = {r["k"]: r["m"] for r in df.select("k", frontage.inside_length(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), F.col("ring")).alias("m")).collect()}
    assert got == {k: pytest.approx(m, abs=1e-9) for k, (_, m) in enumerate(cases)}
    rng = np.random.default_rng(2)
    more = [(k, *[float(c) for c in rng.uniform(-2, 12, 4)], ell) for k in range(40)]
    df = spark.createDataFrame(more, f"k int, ax double, ay double, bx double, by double, ring {RING}")
    inside = lambda x, y: (0 < x < 10 and 0 < y < 4) or (0 < x < 4 and 0 < y < 10)
    for r in df.select("*", frontage.inside_length(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), F.col("ring")).alias("m")).collect():
        ts = (np.arange(4000) + 0.5) / 4000
        share = np.mean([inside(r["ax"] + t * (r["bx"] - r["ax"]), r["ay"] + t * (r["by"] - r["ay"])) for t in ts])
        assert abs(r["m"] - share * np.hypot(r["bx"] - r["ax"], r["by"] - r["ay"])) < 0.02


def test_roads_by_the_metres_inside_and_frontages_by_street(spark):
    square = lambda x, y, w=10, h=10: ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))
    lots = spark.createDataFrame([("a", square(0, 0)), ("b", square(10, 0)), ("r1", square(0, 10, 20, 5)), ("r2", square(20, 0, 5, 15)), ("alone", square(100, 100))], f"lot string, ring {RING}")
    streets = spark.createDataFrame([("north", 1.0, 12.0, 19.0, 12.0), ("east", 22.0, -5.0, 22.0, 14.0), ("poke", 5.0, 9.5, 5.0, 10.4)], "street string, ax double, ay double, bx double, by double")
    roads = {r["lot"]: (r["street"], round(r["street_m_inside"], 6), r["n_streets"]) for r in frontage.road_lots(lots, streets).collect()}
    assert roads == {"r1": ("north", 18.4, 2), "r2": ("east", 14.0, 1)}
    got = {(r["lot"], r["street"], r["rank"]): round(r["length"], 6) for r in frontage.lot_frontages(lots, streets).collect()}
    assert got == {("a", "north", 1): 10.0, ("b", "east", 1): 10.0, ("b", "north", 2): 10.0}


def test_addresses_on_pieces_then_the_lot_then_none(spark):
    square = lambda x, w=10: ring((x, 0), (x + w, 0), (x + w, 10), (x, 10))
    lots = spark.createDataFrame([("a", square(0)), ("b", square(20))], f"lot string, ring {RING}")
    pieces = spark.createDataFrame([("a", "z1", 1, square(0, 5)), ("a", "z2", 2, square(4, 3))], f"lot string, feature_id string, zone_rank int, ring {RING}")
    rows = [(1, 2.5, 5.0, 7, None), (2, 6.5, 5.0, None, "B"), (3, 9.0, 5.0, 3, "A"), (4, 4.5, 5.0, 7, "A"), (5, 22.0, 5.0, 1, None), (6, 8.0, 12.0, 3, None), (7, 8.0, 14.0, 3, None), (8, 22.0, 5.0, 1, None)]
    addresses = spark.createDataFrame(rows, "address_id int, x double, y double, civic int, suffix string")
    got = {r["address_id"]: tuple(r)[1:] for r in frontage.lot_addresses(addresses, lots, pieces).collect()}
    assert got == {
        1: ("a", "within", None, "z1", "piece", 3, False, 4, 5), 2: ("a", "within", None, "z2", "piece", 1, True, 1, 5), 3: ("a", "within", None, "z1", "primary", 2, False, 4, 5), 4: ("a", "within", None, "z1", "piece", 4, False, 4, 5),
        6: ("a", "snapped", 2.0, "z1", "primary", 1, True, 4, 5), 5: ("b", "within", None, None, "none", 1, True, 2, 2), 8: ("b", "within", None, None, "none", 2, False, 2, 2),
    }
