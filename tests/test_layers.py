"""Layers on a pyramid of cells: dissolved ground, inner points, lines run along twice, levels."""

import math

import pytest
from korvane.operators import layers
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def square(x, y, w, h=None):
    h = w if h is None else h
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))


def cells(df, *names):
    return {(r["zoom"], r["cell_x"], r["cell_y"]): tuple(r[n] for n in names) for r in df.collect()}


def test_points_inside_shapes_whose_centroid_is_not(spark):
    shapes = [[ring((0, 0), (9, 0), (9, 1), (1, 1), (1, 10), (0, 10))], [square(0, 0, 10), square(2, 1, 7, 8)], [ring((0, 0), (4, 0), (2, 0))]]
    df = spark.createDataFrame([(k, s) for k, s in enumerate(shapes)], f"k int, s array<array<{POINT}>>")
    got = {r["k"]: (r["_p"]["x"], r["_p"]["y"]) for r in layers.with_inner_point(df, "s").collect()}
    assert got == {0: (0.5, 5.5), 1: (1.0, 5.0), 2: (2.0, 0.0)}
    paths = [ring((0, 0), (10, 0)), ring((0, 0), (1, 0), (6, 0), (10, 0)), ring((3, 3)), ring((2, 2), (2, 2))]
    df = spark.createDataFrame(list(enumerate(paths)), f"k int, s array<{POINT}>")
    got = {r["k"]: (r["_p"]["x"], r["_p"]["y"]) for r in layers.with_middle_vertex(df, "s").collect()}
    assert got == {0: (0, 0), 1: (6, 0), 2: (3, 3), 3: (2, 2)}


def test_ground_counts_once_and_numbers_in_one_cell(spark):
    rows = [([square(0, 0, 6)], 2.0, 4.0), ([square(0, 0, 6)], 1.0, None), ([square(5, 5, 10, 2)], None, 6.0), ([square(-3, 1, 2)], 5.0, 0.0), (None, 9.0, 9.0), ([], 9.0, 9.0), ([square(8, 8, 8), square(10, 10, 4)], 1.0, 2.0)]
    df = spark.createDataFrame(rows, f"s array<array<{POINT}>>, built double, allowed double")
    layer = layers.Layer("lots", df, "s", "built", "allowed", "used_pct", 100.0, measures={"built": F.col("built"), "allowed": F.col("allowed")})
    got = cells(layers.cell_layers([layer], layers.Grid(1, 3, 4.0)), "feature_count", "value", "dissolved_area_m2", "coverage_pct")
    near = lambda *x: tuple(v if v is None else pytest.approx(v) for v in x)
    assert got[3, 0, 0] == near(2, 75.0, 16, 100)  # the centre (3, 3) of both copies
    assert got[3, 1, 1] == near(0, None, 2 * 2 + 3 * 2 - 1, 56.25)
    assert got[3, 2, 1] == near(1, None, 8, 50)  # 6 of the strip's measure is allowed, nothing built
    assert got[3, -1, 0] == near(1, None, 4, 25)
    assert got[3, 2, 2] == near(0, None, 12, 75)
    assert got[3, 2, 3] == near(1, 50.0, 12, 75)  # the hollow square, by (9, 12) in its left part
    assert got[1, 0, 0] == near(4, 100 * 4 / 12, 36 + 20 - 1 + 48, 100 * 103 / 256)
    assert sum(v[2] for k, v in got.items() if k[0] == 3) == pytest.approx(107) == sum(v[2] for k, v in got.items() if k[0] == 1)
    assert sum(v[0] for k, v in got.items() if k[0] == 2) == 5
    assert layers.cell_layers([layers.Layer("none", df.limit(0), "s", "feature_count", "cell_area_m2", "n")], layers.Grid(1, 3, 4.0)).count() == 0


def test_a_shape_that_ends_on_an_edge_lies_in_no_cell_beyond(spark):
    shapes = [square(0, 0, 1), square(1, 1, 2, 1), square(64, 3, 64, 1), square(-1, -1, 1)]
    df = spark.createDataFrame([(k, [s]) for k, s in enumerate(shapes)], f"k int, s array<array<{POINT}>>")
    got = sorted((r["k"], r["_cx"], r["_cy"]) for r in layers.cut_to_cells(df, "s", (64.0, 8.0, 1.0)).collect())
    assert got == [(0, 0, 0), (1, 1, 1), (1, 2, 1), *[(2, x, 3) for x in range(64, 128)], (3, -1, -1)]


def test_a_crowded_cell_is_cut_up(spark):
    rows = [(0, 0, [square(k * 0.01, k * 0.005, 0.3, 0.2)]) for k in range(60)] * 3 + [(1, 0, [square(1, 0, 1)]), (1, 0, [square(1.2, 0.1, 0.3)])]
    df = spark.createDataFrame(rows, f"_cx long, _cy long, s array<array<{POINT}>>")
    got = {r["_cx"]: r["covered"] for r in layers.covered(df, limit=8, depth=2).collect()}
    whole = {r["_cx"]: r["covered"] for r in layers.covered(df).collect()}
    staircase = 0.3 * 0.2 + 59 * (0.01 * 0.2 + 0.005 * 0.3 - 0.01 * 0.005)
    assert got == {0: pytest.approx(staircase), 1: 1.0} == whole


def test_lines_are_cut_at_cells_and_run_once(spark):
    paths = [ring((0, 0), (3, 0), (3, 2)), ring((2.5, 0), (1, 0)), ring((0.5, 0.5), (2.5, 2.5)), ring((2, 2), (1.5, 1.5)), ring((1, 1)), None]
    df = spark.createDataFrame([(p,) for p in paths], f"s array<{POINT}>")
    got = {(r["_cx"], r["_cy"]): r["run"] for r in layers.run_length(df.where("s is not null")).collect()}
    half = pytest.approx(0.5 * 2**0.5)
    assert got == {(0, 0): pytest.approx(1 + 0.5 * 2**0.5), (1, 0): 1.0, (2, 0): 1.0, (3, 0): 1.0, (3, 1): 1.0, (1, 1): pytest.approx(2**0.5), (2, 2): half}
    layer = layers.Layer("streets", df, "s", "dissolved_length_m", "cell_area_m2", "street_km_per_km2", 1000.0, lines=True)
    top = cells(layers.cell_layers([layer], layers.Grid(0, 2, 10.0)), "feature_count", "dissolved_length_m", "value")[0, 0, 0]
    assert top == (5, pytest.approx(5 + 2 * 2**0.5), pytest.approx(1000 * (5 + 2 * 2**0.5) / 1600))


def test_web_cells_have_their_area_on_the_sphere(spark):
    n = 1 << 14
    lon = lambda x: x / n * 360 - 180
    lat = lambda y: math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * y / n))))
    full = ring((lon(4700), lat(5800)), (lon(4702), lat(5800)), (lon(4702), lat(5802)), (lon(4700), lat(5802)))
    df = spark.createDataFrame([([full],)], f"s array<array<{POINT}>>")
    got = cells(layers.cell_layers([layers.Layer("block", df, "s", "feature_count", "cell_area_m2", "n")], layers.Grid(1, 14)), "feature_count", "coverage_pct", "dissolved_area_m2")
    at = got[13, 2350, 2900]
    exact = layers.SPHERE_M**2 * math.radians(lon(4702) - lon(4700)) * (math.sin(math.radians(lat(5800))) - math.sin(math.radians(lat(5802))))
    assert at == (1, pytest.approx(100, rel=1e-6), pytest.approx(exact, rel=1e-6))
    assert got[1, 0, 0][2] == pytest.approx(exact, rel=1e-6)
