"""Setbacks on lots of any shape: sorted boundaries, differences of polygons that come back as rings, and what may be built on.

A shape is an array of rings, a ring an array of struct(x, y) in metres; inner rings are holes by the even-odd rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lots import SIDE_MARGINS
from .polygons import ALONG_SINE, PIECE_M, SLACK_M, heights, side_pieces, sides_of, signed_area
from .spatial import edges

#: Sides of a round cap's quarter; lengths below SNAP are none.
QUARTER, SNAP = 8, 1e-7
LINE_KINDS = np.array(["front", "secondary", "other", "rear", "side"], dtype=object)
RINGS = "array<array<struct<x:double,y:double>>>"


# Boolean operations: strips between the heights at which something happens, sides within them, and rings around what stays.


def capsule(ax: float, ay: float, bx: float, by: float, m: float) -> np.ndarray:
    """The ground within m of a segment as sides (n, 4): the ends are half circles of 2 QUARTER sides."""
    along = np.arctan2(by - ay, bx - ax)
    turn = np.linspace(-np.pi / 2, np.pi / 2, 2 * QUARTER + 1)
    ends = [(bx + m * np.cos(along + t), by + m * np.sin(along + t)) for t in turn] + [(ax + m * np.cos(along + np.pi + t), ay + m * np.sin(along + np.pi + t)) for t in turn]
    p = np.array(ends)
    return np.concatenate([p, np.roll(p, -1, 0)], 1)


def strips_where(shapes: list[np.ndarray], keep) -> list[tuple[float, float, list[tuple[float, float, float, float]]]]:
    """(low, high, [(left at low, left at high, right at low, right at high)]) of the ground where keep(inside each shape) holds."""
    owner = np.repeat(np.arange(len(shapes)), [len(s) for s in shapes])
    sides = np.concatenate(shapes)
    ys = heights(sides)
    ys = ys[np.concatenate([[True], np.diff(ys) > SNAP / 10])]
    out = []
    for lo, hi in zip(ys[:-1], ys[1:], strict=True):
        mid = (lo + hi) / 2
        met = (sides[:, 1] > mid) != (sides[:, 3] > mid)
        s, own = sides[met], owner[met]
        at = lambda y, s=s: s[:, 0] + (y - s[:, 1]) * (s[:, 2] - s[:, 0]) / (s[:, 3] - s[:, 1])
        low, high, middle = at(lo), at(hi), at(mid)
        inside, was, found = [False] * len(shapes), False, []
        for k in np.argsort(middle, kind="stable"):
            inside[own[k]] = not inside[own[k]]
            if keep(inside) != was:
                was = not was
                if was:
                    left = (low[k], high[k])
                elif middle[k] - (left[0] + left[1]) / 2 > SNAP:
                    found.append((*left, low[k], high[k]))
        if found:
            out.append((lo, hi, found))
    return out


def rings_around(strips) -> list[np.ndarray]:
    """Rings around strips, outer ones counter-clockwise and holes clockwise, the largest first: their slanted sides, and of the level ones those where only one side is kept."""
    level: dict[float, dict[str, list]] = {}
    for lo, hi, found in strips:
        for ll, lh, rl, rh in found:
            level.setdefault(lo, {"up": [], "down": []})["up"].append((ll, rl))
            level.setdefault(hi, {"up": [], "down": []})["down"].append((lh, rh))
    snapped: dict[float, np.ndarray] = {}
    for y, both in level.items():
        xs = np.unique([x for part in both.values() for pair in part for x in pair])
        snapped[y] = xs[np.concatenate([[True], np.diff(xs) > SNAP])]
    on = lambda x, y: (float(snapped[y][max(np.searchsorted(snapped[y], x + SNAP / 100, side="right") - 1, 0)]), y)
    sides = []
    for lo, hi, found in strips:
        for ll, lh, rl, rh in found:
            sides += [(on(lh, hi), on(ll, lo)), (on(rl, lo), on(rh, hi))]
    for y, both in level.items():
        xs = snapped[y]
        for a, b in zip(xs[:-1], xs[1:], strict=True):
            m = (a + b) / 2
            above, below = (any(on(p, y)[0] < m < on(q, y)[0] for p, q in both[part]) for part in ("up", "down"))
            if above != below:
                sides.append(((float(a), y), (float(b), y)) if above else ((float(b), y), (float(a), y)))
    follow: dict[tuple, list[tuple]] = {}
    for a, b in sides:
        if a != b:
            follow.setdefault(a, []).append(b)
    rings = []
    for start in sorted(follow):
        while follow[start]:
            line, at = [start], follow[start].pop()
            while at != start and follow.get(at):
                line.append(at)
                at = follow[at].pop()
            ring = straight(np.array(line))
            if len(ring) > 2:
                rings.append(ring)
    return sorted(rings, key=lambda r: -abs(area_of(r)))


def area_of(ring: np.ndarray) -> float:
    x, y = ring.T
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2


def straight(ring: np.ndarray) -> np.ndarray:
    """A ring without the points that lie on the line between their neighbours."""
    a, b = np.roll(ring, 1, 0), np.roll(ring, -1, 0)
    d = b - a
    off = np.abs(d[:, 0] * (ring[:, 1] - a[:, 1]) - d[:, 1] * (ring[:, 0] - a[:, 0]))
    return ring[off > SNAP * np.maximum(np.hypot(d[:, 0], d[:, 1]), SNAP)]


def less(shape: Column, cuts: Column, within: Column | None = None) -> Column:
    """What a shape has outside the ground within m of segments (array<struct(ax, ay, bx, by, m)>), and inside another shape where one is given: rings as in rings_around(). Null for a null shape; null cuts or m are none.

    Each shape is worked out as seen from its first corner, and rows of a batch that are alike but for their place only once.
    """

    @F.pandas_udf(RINGS)
    def run(shapes: pd.Series, segments: pd.Series, windows: pd.Series) -> pd.Series:
        out, known = [], {}
        for rings, lines, window in zip(shapes, segments, windows, strict=True):
            if rings is None:
                out.append(None)
                continue
            own = sides_of(rings)
            if not len(own):
                out.append([])
                continue
            x, y = own[0, :2]
            at = np.array([x, y, x, y])
            capsules = np.array([[e[c] for c in ("ax", "ay", "bx", "by", "m")] for e in (lines if lines is not None else []) if e["m"] is not None and e["m"] > 0], float).reshape(-1, 5)
            capsules[:, :4] -= at
            # A part without sides has no ground: a window of none leaves nothing.
            parts = [own - at, *([sides_of(window) - at] if window is not None else [])]
            key = (capsules.tobytes(), *[p.tobytes() for p in parts])
            if key not in known:
                n = len(capsules)
                keep = lambda s, n=n, w=window is not None: s[0] and not any(s[1 : n + 1]) and (not w or s[-1])
                known[key] = rings_around(strips_where([parts[0], *[capsule(*e) for e in capsules], *parts[1:]], keep))
            out.append([[{"x": float(px + x), "y": float(py + y)} for px, py in ring] for ring in known[key]])
        return pd.Series(out, dtype=object)

    return run(shape, cuts, within if within is not None else F.lit(None).cast(RINGS))


def shape_area(shape: Column) -> Column:
    """The area of rings as rings_around() gives them: holes run the other way and count against it."""
    return F.abs(F.aggregate(shape, F.lit(0.0), lambda s, r: s + signed_area(r)))


# Sorted boundaries.


def boundary_lines(lots: DataFrame, front: DataFrame, piece: float = PIECE_M, sine: float = ALONG_SINE, slack: float = SLACK_M) -> DataFrame:
    """(lot, kind, ax, ay, bx, by, m, along_m): the boundary of lots (lot, shape) as straight lines of one kind each, m long.

    front (lot, rank, ax, ay, bx, by) are street sides. What runs along one of rank 1 is front, of rank 2 secondary, of
    others other. The rest is cut into pieces of at most `piece`: rear where the ends' distances to the front differ by at most `sine`
    of the piece's length, else side. Neighbouring pieces of a side and a kind are one line; along_m is how much of it
    runs so, whatever its kind. Holes are boundary too. Lots without a front are left out.
    """
    street = F.struct(F.col("rank").cast("int").alias("rank"), *[F.col(c).cast("double").alias(c) for c in ("ax", "ay", "bx", "by")])
    streets = front.groupBy("lot").agg(F.collect_list(street).alias("streets")).where(F.exists("streets", lambda s: s["rank"] == 1))
    n = int(lots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = lots.select("lot", F.explode(F.flatten(F.transform("shape", edges))).alias("e")).select("lot", *[F.col(f"e.{p}.{c}").alias(p + c) for p in "ab" for c in "xy"])
    # Dealt over all partitions, however few bytes they are: a side makes many pieces. Streets are no broadcast.
    sides = sides.repartition(n, "lot").join(streets.repartition(n, "lot").hint("merge"), "lot")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                ax, ay, bx, by = ends = [part.column(c).to_numpy(zero_copy_only=False) for c in ("ax", "ay", "bx", "by")]
                row, k, n, m, touched, along = side_pieces(*ends, part.column("streets"), piece, sine, slack)
                kind = np.select([touched == 1, touched == 2, np.isfinite(touched), along], [0, 1, 2, 3], 4)
                starts = np.flatnonzero(np.concatenate([np.ones(min(len(row), 1), bool), (np.diff(row) != 0) | (np.diff(kind) != 0)]))
                stops = np.concatenate([starts[1:], np.full(min(len(row), 1), len(row), int)]) - 1
                side = row[starts]
                at = lambda a, b, k: a[side] + (b - a)[side] * k / n[side]  # noqa: B023, E731
                spots = [at(ax, bx, k[starts]), at(ay, by, k[starts]), at(ax, bx, k[stops] + 1), at(ay, by, k[stops] + 1)]
                sums = [np.add.reduceat(x, starts) if len(starts) else np.zeros(0) for x in (m, np.where(along, m, 0.0))]
                yield pa.RecordBatch.from_arrays([part.column("lot").take(pa.array(side)), pa.array(LINE_KINDS[kind[starts]], pa.string()), *[pa.array(x) for x in (*spots, *sums)]], ["lot", "kind", "ax", "ay", "bx", "by", "m", "along_m"])

    key = {f.name: f.dataType.simpleString() for f in lots.schema}["lot"]
    return sides.mapInArrow(lines, f"lot {key}, kind string, ax double, ay double, bx double, by double, m double, along_m double")


def buildable(lots: DataFrame, front: DataFrame, envelopes: DataFrame) -> DataFrame:
    """envelopes with front_edge_m, secondary_edge_m, rear_edge_m, side_edge_m, secondary_is_rear, side_setback_m, buildable, buildable_area_m2, buildable_pct, coverage_cap_m2, footprint_cap_m2 and binding.

    lots (lot, shape), front as in boundary_lines(), envelopes (lot, piece: the ground that the zone governs, null is all,
    front_m, secondary_m, rear_m, side_m: margins, null is none, attachment: attached, semi, detached or null,
    rear_on_street_m: the margin of a second street that is the lot's rear line, null is secondary_m, coverage_max_pct).

    The ground within its margin of each boundary line goes, round at corners, and the rest is cut with the piece.
    Attached buildings keep no side margin and semi-detached ones half. coverage_cap_m2 is the share of the piece's ground
    that may be covered; the footprint is capped by it (binding site_coverage) or by the buildable ground (setbacks).
    Envelopes of lots without a front are left out, as nothing says where their rear is.
    """
    lines = boundary_lines(lots, front)
    total = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("m"))), F.lit(0.0)).alias(f"{k}_edge_m")
    secondary = F.col("kind") == "secondary"
    is_rear = F.coalesce(F.sum(F.when(secondary, F.col("along_m"))) * 2 > F.sum(F.when(secondary, F.col("m"))), F.lit(False))
    each = lines.groupBy("lot").agg(*[total(k) for k in ("front", "secondary", "rear", "side")], is_rear.alias("secondary_is_rear"), F.collect_list(F.struct("kind", "ax", "ay", "bx", "by")).alias("_lines"))
    share = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in SIDE_MARGINS.items() for x in kv]), F.col("attachment")), F.lit(1.0))
    rows = envelopes.join(lots.select("lot", F.col("shape").alias("_shape")).hint("merge"), "lot").join(each.hint("merge"), "lot").withColumn("side_setback_m", F.coalesce("side_m", F.lit(0.0)) * share)
    second = F.when(F.col("secondary_is_rear"), F.coalesce("rear_on_street_m", "secondary_m")).otherwise(F.col("secondary_m"))
    margin = lambda kind: F.when(kind == "front", F.col("front_m")).when(kind == "secondary", second).when(kind == "rear", F.col("rear_m")).when(kind == "side", F.col("side_setback_m"))
    cuts = F.transform("_lines", lambda e: F.struct(e["ax"].alias("ax"), e["ay"].alias("ay"), e["bx"].alias("bx"), e["by"].alias("by"), margin(e["kind"]).cast("double").alias("m")))
    # Shapes that are alike but for their place meet in one task, where they are worked out once.
    n, corner = int(lots.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.get(F.get("_shape", 0), 0)
    alike = F.transform("_shape", lambda r: F.transform(r, lambda p: F.struct(p["x"] - corner["x"], p["y"] - corner["y"])))
    rows = rows.repartition(n, alike, "front_m", "rear_m", "side_setback_m").withColumn("buildable", less(F.col("_shape"), cuts, F.col("piece")))
    even_odd = lambda shape: F.aggregate(shape, F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("a")), lambda s, r: F.struct((s["k"] + 1).alias("k"), (s["a"] + F.when(s["k"] == 0, F.abs(signed_area(r))).otherwise(-F.abs(signed_area(r)))).alias("a")))["a"]
    ground = F.coalesce(F.col("piece_area_m2"), even_odd(F.col("_shape"))) if "piece_area_m2" in envelopes.columns else even_odd(F.coalesce("piece", "_shape"))
    rows = rows.withColumns({"buildable_area_m2": shape_area(F.col("buildable")), "_ground": ground})
    cap = F.col("_ground") * F.col("coverage_max_pct") / 100
    rows = rows.withColumns({"buildable_pct": F.when(F.col("_ground") > 0, 100 * F.col("buildable_area_m2") / F.col("_ground")), "coverage_cap_m2": cap, "footprint_cap_m2": F.least("buildable_area_m2", cap)})
    return rows.withColumn("binding", F.when(F.coalesce(cap < F.col("buildable_area_m2"), F.lit(False)), "site_coverage").otherwise("setbacks")).drop("_lines", "_shape", "_ground")
