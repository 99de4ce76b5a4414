"""Boolean operations on polygons and setbacks, against grids of points and closed forms."""

import math

import numpy as np
import pytest
from korvane.operators import setbacks
from korvane.operators.polygons import sides_of
from pyspark.sql import functions as F


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def holds(sides, x, y):
    met = (sides[:, 1] > y) != (sides[:, 3] > y)
    s = sides[met]
    return (s[:, 0] + (y - s[:, 1]) * (s[:, 2] - s[:, 0]) / (s[:, 3] - s[:, 1]) > x).sum() % 2 == 1


def test_differences_equal_a_grid_of_points():
    rng = np.random.default_rng(8)
    for k in range(25):
        angles = np.sort(rng.uniform(0, 2 * math.pi, rng.integers(4, 10)))
        star = [ring(*[(r * math.cos(a), r * math.sin(a)) for a, r in zip(angles, rng.uniform(6, 12, len(angles)), strict=True)]), ring((-1, -1), (1, -1), (1, 1), (-1, 1))][: 1 + k % 2]
        shape = sides_of(star)
        cuts = [setbacks.capsule(*rng.uniform(-9, 9, 4), rng.uniform(0.3, 3)) for _ in range(k % 5)]
        window = [sides_of([ring((-8, -7), (9, -8), (2, 9))])] if k % 3 == 0 else []
        keep = lambda s, n=len(cuts), w=bool(window): s[0] and not any(s[1 : n + 1]) and (not w or s[-1])
        strips = setbacks.strips_where([shape, *cuts, *window], keep)
        rings = setbacks.rings_around(strips)
        area = sum((hi - lo) * (rl - ll + rh - lh) / 2 for lo, hi, found in strips for ll, lh, rl, rh in found)
        assert abs(sum(map(setbacks.area_of, rings)) - area) < 1e-6
        result = sides_of([ring(*r) for r in rings])
        for x, y in rng.uniform(-12, 12, (300, 2)):
            want = keep([holds(s, x, y) for s in [shape, *cuts, *window]])
            assert (holds(result, x, y) if len(result) else False) == want


def test_rings_of_simple_differences(spark):
    square, hole = ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((4, 4), (6, 4), (6, 6), (4, 6))
    rows = [(1, [square], None, None), (2, [square, hole], [], None), (3, None, None, None), (4, [square], None, [ring((5, -5), (20, -5), (20, 20), (5, 20))]), (5, [square], [{"ax": 5.0, "ay": -9.0, "bx": 5.0, "by": 19.0, "m": 1.0}], None), (6, [square], [{"ax": 5.0, "ay": 5.0, "bx": 5.0, "by": 5.0, "m": 99.0}], None), (7, [square], [{"ax": 0.0, "ay": 0.0, "bx": 1.0, "by": 0.0, "m": None}], None)]
    df = spark.createDataFrame(rows, f"k int, s {setbacks.RINGS}, c array<struct<ax:double,ay:double,bx:double,by:double,m:double>>, w {setbacks.RINGS}")
    df = df.withColumn("out", setbacks.less(F.col("s"), F.col("c"), F.col("w")))
    got = {r["k"]: (r["out"] and [len(x) for x in r["out"]], r["a"]) for r in df.select("k", "out", setbacks.shape_area(F.col("out")).alias("a")).collect()}
    assert {k: (n, a and pytest.approx(a)) for k, (n, a) in got.items()} == {1: ([4], 100), 2: ([4, 4], 96), 3: (None, None), 4: ([4], 50), 5: ([4, 4], 80), 6: ([], 0.0), 7: ([4], 100)}


def test_corner_and_through_lots(spark):
    """A corner lot keeps its second street's margin, a through lot takes the rear margin on the street."""
    shape = [ring((0, 0), (20, 0), (20, 30), (0, 30))]
    lots = spark.createDataFrame([(k, shape) for k in range(4)], f"lot int, shape {setbacks.RINGS}")
    side = lambda lot, rank, a, b: (lot, rank, float(a[0]), float(a[1]), float(b[0]), float(b[1]))
    front = [side(k, 1, (-5, 0), (25, 0)) for k in (0, 1, 2)] + [side(1, 2, (20, 0), (20, 30)), side(2, 2, (0, 30), (20, 30)), side(0, 3, (0, 0), (0, 30))]
    front = spark.createDataFrame(front, "lot int, rank int, ax double, ay double, bx double, by double")
    rows = [(k, None, 3.0, 2.0, 5.0, 4.0, a, 6.0, c) for k in range(4) for a, c in (("detached", None), ("semi", 10.0), ("attached", 90.0))]
    envelopes = spark.createDataFrame(rows, f"lot int, piece {setbacks.RINGS}, front_m double, secondary_m double, rear_m double, side_m double, attachment string, rear_on_street_m double, coverage_max_pct double")
    got = {(r["lot"], r["attachment"]): r for r in setbacks.buildable(lots, front, envelopes).collect()}
    assert {k for k, _ in got} == {0, 1, 2}
    area = {k: round(r["buildable_area_m2"], 6) for k, r in got.items()}
    assert area == {(0, "detached"): 16 * 22, (0, "semi"): 18 * 22, (0, "attached"): 20 * 22, (1, "detached"): 14 * 22, (1, "semi"): 16 * 22, (1, "attached"): 18 * 22, (2, "detached"): 12 * 21, (2, "semi"): 16 * 21, (2, "attached"): 20 * 21}
    assert [got[k, "semi"]["secondary_is_rear"] for k in (0, 1, 2)] == [False, False, True]
    assert (got[1, "semi"]["binding"], got[1, "semi"]["footprint_cap_m2"], got[1, "attached"]["binding"], got[1, "detached"]["coverage_cap_m2"]) == ("site_coverage", 60.0, "setbacks", None)
    lines = {(r["kind"], r["m"]) for r in setbacks.boundary_lines(lots, front).where("lot = 1").collect()}
    assert {(k, round(m, 6)) for k, m in lines} == {("front", 20.0), ("secondary", 30.0), ("rear", 20.0), ("side", 30.0)}
