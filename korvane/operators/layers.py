"""Layers of shapes summed up on a pyramid of cells: dissolved area and length, measures of features, a ratio and a coverage at each level.

Two rules place things. Ground belongs to each cell that it lies in: shapes are clipped to the finest cells and what lies
under several of them counts once. Numbers of a feature belong to one cell, that of a point inside it, so that counts stay
whole. Both add up exactly from level to level, since four cells tile their parent; a ratio is worked out anew at each level.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import worked_out
from ..functions.grid import EDGE
from ..storage import stage
from .polygons import clip, covered_length, sides_of, strips
from .spatial import box_of, edges, ring_area, with_cells

#: Mean radius of the sphere that the areas of web cells are taken on.
SPHERE_M = 6371008.8
CELL = ["_cx", "_cy"]


@dataclass(frozen=True)
class Grid:
    """Square cells of `side` in a metric plane from (x0, y0), or web-mercator cells of lon/lat where `side` is None. A level's cells are twice as wide as the next finer one's."""

    coarsest: int
    finest: int
    side: float | None = None
    x0: float = 0.0
    y0: float = 0.0

    def place(self, p: Column) -> Column:
        """A point in units of the finest cells; rows of web cells run south."""
        if self.side:
            return F.struct(((p["x"] - self.x0) / self.side).alias("x"), ((p["y"] - self.y0) / self.side).alias("y"))
        n = float(1 << self.finest)
        lat = F.radians(F.least(F.greatest(p["y"], F.lit(-EDGE)), F.lit(EDGE)))
        return F.struct(((p["x"] + 180) / 360 * n).alias("x"), ((1 - F.asinh(F.tan(lat)) / math.pi) / 2 * n).alias("y"))

    def cell_area(self, y: Column, zoom: Column) -> Column:
        """Square metres of a cell in row y: exact on the sphere for web cells, between two parallels and two meridians."""
        if self.side:
            return F.pow(F.lit(self.side) * F.pow(F.lit(2.0), self.finest - zoom), F.lit(2.0))
        n = F.pow(F.lit(2.0), zoom)
        sine = lambda row: F.tanh(F.lit(math.pi) * (1 - 2 * row / n))
        return SPHERE_M**2 * 2 * math.pi / n * (sine(y) - sine(y + 1))


@dataclass(frozen=True)
class Layer:
    """Rows with a column `shape`: an array of rings (inner ones are holes), or with `lines` one path. Points are struct(x, y).

    `measures` are numbers of a row, summed by cell. The value of a cell is scale * numerator / denominator, of measures or
    of feature_count, dissolved_area_m2, dissolved_length_m and cell_area_m2; null where the denominator is null or 0.
    """

    name: str
    rows: DataFrame
    shape: str
    numerator: str
    denominator: str
    kind: str
    scale: float = 1.0
    lines: bool = False
    measures: dict[str, Column] = field(default_factory=dict)


def window(x: Column, y: Column, size: float) -> Column:
    """The square cell (x, y) of the size, as a ring."""
    corner = lambda i, j: F.struct(((x + i) * size).alias("x"), ((y + j) * size).alias("y"))
    return F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))


def cut_to_cells(df: DataFrame, shape: str, sizes: tuple[float, ...]) -> DataFrame:
    """df once for each cell of the last size that its shape has area in, with what lies there as `shape`, and the cell as _cx, _cy.

    Sizes fall, so that a large shape is cut into large pieces first: the work follows its cells and not cells times points.
    A shape that lies in one cell is not clipped. There is no shuffle.
    """
    for size in sizes:
        df = with_cells(df.withColumn("_around", box_of(F.flatten(shape))), F.col("_around"), size)
        cell = window(F.col("_cx"), F.col("_cy"), size)
        # The box may end on an edge: the cell beyond it holds none of the shape.
        alone = lambda c: (F.floor(F.col(f"_around.{c}0") / size) == F.col("_c" + c)) & (F.ceil(F.col(f"_around.{c}1") / size) - 1 == F.col("_c" + c))  # noqa: B023, E731
        parts = F.filter(F.transform(shape, lambda r: clip(r, cell)), lambda r: F.size(r) > 2)  # noqa: B023
        kept = worked_out(df, _kept=F.when(alone("x") & alone("y"), F.col(shape)).otherwise(parts)).drop(shape, "_around")
        df = kept.where((F.size("_kept") > 0) & F.exists("_kept", lambda r: ring_area(r) > 0)).withColumnRenamed("_kept", shape)
    return df


def covered(pieces: DataFrame, limit: int = 256, depth: int = 3) -> DataFrame:
    """(_cx, _cy, covered) for pieces (_cx, _cy, s) of unit cells: the share of a cell that they cover, ground under several of them once.

    Equal pieces are one. Where a piece fills its cell nothing else matters there. A cell of more than `limit` pieces is
    cut into 16 x 16, up to `depth` times, so that no task gets a pile of them.
    """
    key = [*CELL, "_sx", "_sy"]
    rest = pieces.select(*CELL, F.lit(0).cast("long").alias("_sx"), F.lit(0).cast("long").alias("_sy"), "s")
    size, done = 1.0, []

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[CELL].iloc[:1].assign(covered=strips([sides_of(s) for s in pdf["s"]], covered_length))

    kinds = {f.name: f.dataType.simpleString() for f in rest.schema}
    form = ", ".join(f"{c} {kinds[c]}" for c in CELL) + ", covered double"
    for k in range(depth + 1):
        rest = stage(rest.distinct(), "cell-pieces")
        filled = (F.size("s") == 1) & (ring_area(F.get("s", 0)) >= size * size * (1 - 1e-12))
        state = rest.groupBy(*key).agg(F.count("*").alias("_n"), F.max(filled).alias("_full"))
        done.append(state.where("_full").select(*CELL, F.lit(size * size).alias("covered")))
        few = F.lit(True) if k == depth else F.col("_n") <= limit
        done.append(rest.join(state.where(~F.col("_full") & few).select(*key), key, "left_semi").groupBy(*key).applyInPandas(run, form))
        if k == depth or (many := state.where(~F.col("_full") & ~few).select(*key)).isEmpty():
            break
        size /= 16
        again = rest.join(many, key, "left_semi").select(F.col("_cx").alias("_x"), F.col("_cy").alias("_y"), "s")
        rest = cut_to_cells(again, "s", (size,)).select(F.col("_x").alias("_cx"), F.col("_y").alias("_cy"), F.col("_cx").alias("_sx"), F.col("_cy").alias("_sy"), "s")
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.groupBy(*CELL).agg(F.sum("covered").alias("covered"))


def run_length(paths: DataFrame) -> DataFrame:
    """(_cx, _cy, run) for paths (s): the length of line in each unit cell, line that several paths run along once.

    A segment is cut by columns and then by rows, so it makes a row for each cell that it crosses. On an edge between two
    cells it belongs to the one above or to the right. Pieces on one straight line are merged as intervals in order.
    """
    n = F.size("s")
    sides = F.when(n > 1, F.transform(F.slice("s", 1, n - 1), lambda p, i: F.struct(p.alias("a"), F.get("s", i + 1).alias("b"))))
    e = paths.select(F.explode(sides).alias("e")).where("e.a != e.b")
    for axis, cell in (("x", "_cx"), ("y", "_cy")):
        p, q = F.col(f"e.a.{axis}"), F.col(f"e.b.{axis}")
        kept = [c for c in e.columns if c != "e"]
        e = e.withColumn(cell, F.explode(F.sequence(F.floor(F.least(p, q)), F.floor(F.greatest(p, q)))))
        t = lambda v: (v - p) / F.nullif(q - p, F.lit(0.0))  # noqa: B023, E731
        lo, hi = F.least(t(F.col(cell)), t(F.col(cell) + 1)), F.greatest(t(F.col(cell)), t(F.col(cell) + 1))
        e = e.withColumn("_t", F.coalesce(F.greatest(lo, F.lit(0.0)), F.lit(0.0))).withColumn("_u", F.coalesce(F.least(hi, F.lit(1.0)), F.lit(1.0))).where("_u > _t")
        on = lambda t: F.struct(*[(F.col(f"e.a.{c}") + F.col(t) * (F.col(f"e.b.{c}") - F.col(f"e.a.{c}"))).alias(c) for c in ("x", "y")])
        e = e.select(*kept, cell, F.struct(on("_t").alias("a"), on("_u").alias("b")).alias("e"))
    # Left to right, and upwards where upright; seen from the cell's corner, so that rounding is of small numbers.
    turned = F.col("e").isNotNull() & ((F.col("e.a.x") > F.col("e.b.x")) | ((F.col("e.a.x") == F.col("e.b.x")) & (F.col("e.a.y") > F.col("e.b.y"))))
    seen = lambda c: [(F.when(turned, F.col(f"e.{b}.{c}")).otherwise(F.col(f"e.{a}.{c}")) - F.col("_c" + c)).alias(a + c) for a, b in (("a", "b"), ("b", "a"))]
    flat = e.select(*CELL, *seen("x"), *seen("y")).withColumn("_m", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))).where("_m > 0")
    flat = flat.withColumn("_ux", (F.col("bx") - F.col("ax")) / F.col("_m")).withColumn("_uy", (F.col("by") - F.col("ay")) / F.col("_m"))
    line = [F.round("_ux", 9).alias("_ux"), F.round("_uy", 9).alias("_uy"), F.round(F.expr("ax * _uy - ay * _ux"), 9).alias("_off")]
    along = flat.select(*CELL, *line, F.round(F.expr("ax * _ux + ay * _uy"), 12).alias("_from"), F.round(F.expr("bx * _ux + by * _uy"), 12).alias("_to")).distinct()
    before = Window.partitionBy(*CELL, "_ux", "_uy", "_off").orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)
    start = F.greatest("_from", F.coalesce(F.max("_to").over(before), F.col("_from")))
    return along.withColumn("_new", F.greatest(F.col("_to") - start, F.lit(0.0))).groupBy(*CELL).agg(F.sum("_new").alias("run"))


def with_inner_point(df: DataFrame, shape: str) -> DataFrame:
    """df with _p, a point inside the shape, also where its centroid is not.

    It stands at half the height between the two vertex heights next to the middle of the box, in the middle of the widest
    stretch inside (the leftmost of equal ones). A shape without height has the middle of its box.
    """
    box = worked_out(df, _b=box_of(F.flatten(shape)), _ys=F.transform(F.flatten(shape), lambda p: p["y"]))
    mid = (F.col("_b.y0") + F.col("_b.y1")) / 2
    at = worked_out(box, _y=(F.array_max(F.filter("_ys", lambda y: y <= mid)) + F.array_min(F.filter("_ys", lambda y: y > mid))) / 2)
    meets = lambda e: e["a"]["x"] + (F.col("_y") - e["a"]["y"]) * (e["b"]["x"] - e["a"]["x"]) / (e["b"]["y"] - e["a"]["y"])
    crossed = lambda r: F.transform(F.filter(edges(r), lambda e: (e["a"]["y"] > F.col("_y")) != (e["b"]["y"] > F.col("_y"))), meets)
    at = worked_out(at, _xs=F.array_sort(F.flatten(F.transform(shape, crossed))))
    x = lambda i: F.get("_xs", i)
    stretch = lambda i: F.struct((x(2 * i + 1) - x(2 * i)).alias("w"), (-x(2 * i)).alias("left"), ((x(2 * i) + x(2 * i + 1)) / 2).alias("x"))
    widest = F.when(F.size("_xs") > 1, F.array_max(F.transform(F.sequence(F.lit(0), (F.size("_xs") / 2).cast("int") - 1), stretch)))["x"]
    p = F.struct(F.coalesce(widest, (F.col("_b.x0") + F.col("_b.x1")) / 2).alias("x"), F.coalesce(F.when(widest.isNotNull(), F.col("_y")), mid).alias("y"))
    return at.withColumn("_p", p).drop("_b", "_ys", "_y", "_xs")


def with_middle_vertex(df: DataFrame, path: str) -> DataFrame:
    """df with _p, the vertex of the path nearest its centroid: of those between the ends if there are any; the first of equal ones."""
    n = F.size(path)
    sides = F.when(n > 1, F.transform(F.slice(path, 1, n - 1), lambda p, i: F.struct(p.alias("a"), F.get(path, i + 1).alias("b"))))
    add = lambda s, e: F.struct(*[(s[c] + F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]) * w).alias(c) for c, w in (("m", F.lit(1.0)), ("x", (e["a"]["x"] + e["b"]["x"]) / 2), ("y", (e["a"]["y"] + e["b"]["y"]) / 2))])
    sums = F.aggregate(F.coalesce(sides, F.array().cast("array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>")), F.struct(*[F.lit(0.0).alias(c) for c in "mxy"]), add)
    df = df.withColumn("_s", sums).withColumn("_v", F.when(n > 2, F.slice(path, 2, F.greatest(n - 2, F.lit(1)))).otherwise(F.col(path)))
    off = lambda p, i: F.struct(F.pow(p["x"] - F.col("_s.x") / F.col("_s.m"), F.lit(2.0)) + F.pow(p["y"] - F.col("_s.y") / F.col("_s.m"), F.lit(2.0)), i, p.alias("p"))
    return df.withColumn("_p", F.when(F.col("_s.m") > 0, F.array_min(F.transform("_v", off))["p"]).otherwise(F.get(path, 0))).drop("_s", "_v")


def finest_cells(layer: Layer, grid: Grid) -> DataFrame:
    """(_cx, _cy, area, length, feature_count, measures) of the finest cells that a layer has ground in. Null and empty shapes have no part in it."""
    point = "struct<x:double,y:double>"
    placed = (lambda c: F.transform(c, grid.place)) if layer.lines else (lambda c: F.transform(c, lambda r: F.transform(r, grid.place)))
    kind = f"array<{point}>" if layer.lines else f"array<array<{point}>>"
    named = {f"m{k}": c.cast("double") for k, c in enumerate(layer.measures.values())}
    rows = layer.rows.select(placed(F.col(layer.shape)).cast(kind).alias("s"), *[c.alias(k) for k, c in named.items()])
    rows = rows.where(F.size("s") > 0 if layer.lines else F.size(F.flatten("s")) > 0)
    ground = grid.cell_area(F.col("_cy"), F.lit(grid.finest))
    if layer.lines:
        shape = run_length(rows.select("s").distinct()).select(*CELL, F.lit(0.0).alias("area"), (F.col("run") * F.sqrt(ground)).alias("length"))
        pointed = with_middle_vertex(rows, "s")
    else:
        shape = covered(cut_to_cells(rows.select("s").distinct(), "s", (64.0, 8.0, 1.0))).select(*CELL, (F.col("covered") * ground).alias("area"), F.lit(0.0).alias("length"))
        pointed = with_inner_point(rows, "s")
    sums = pointed.select(F.floor("_p.x").alias("_cx"), F.floor("_p.y").alias("_cy"), *named).groupBy(*CELL).agg(F.count("*").alias("feature_count"), *[F.sum(k).alias(k) for k in named])
    return shape.join(sums, CELL, "left")


def cell_layers(layers: list[Layer], grid: Grid) -> DataFrame:
    """(layer, zoom, cell_x, cell_y, feature_count, value, value_kind, dissolved_area_m2, dissolved_length_m, cell_area_m2, coverage_pct, attributes).

    One row for each layer, level and cell with ground in it. A cell that a shape only reaches into has a feature_count of
    0 and null measures. Measures go into `attributes`, a map; those that are null throughout stay null. Only sums of the
    finest cells go up the levels. Null shapes, and shapes without area or length, leave no row of their own; repeated rows
    count as features of their own but cover ground once.
    """
    found = []
    for layer in layers:
        named = {f"m{k}": name for k, name in enumerate(layer.measures)}
        up = stage(finest_cells(layer, grid), "layer-cells").withColumn("zoom", F.explode(F.sequence(F.lit(grid.coarsest), F.lit(grid.finest))))
        parent = lambda c: F.floor(F.col("_c" + c) / F.pow(F.lit(2.0), grid.finest - F.col("zoom"))).alias("cell_" + c)
        total = {"area": "dissolved_area_m2", "length": "dissolved_length_m", **named}
        level = up.groupBy("zoom", parent("x"), parent("y")).agg(F.coalesce(F.sum("feature_count"), F.lit(0)).alias("feature_count"), *[F.sum(k).alias(k) for k in total])
        level = level.withColumn("cell_area_m2", grid.cell_area(F.col("cell_y"), F.col("zoom")))
        source = {"feature_count": F.col("feature_count"), "cell_area_m2": F.col("cell_area_m2"), **{name: F.col(k) for k, name in total.items()}}
        value = layer.scale * source[layer.numerator] / F.nullif(source[layer.denominator].cast("double"), F.lit(0.0))
        pairs = [x for k, name in named.items() for x in (F.lit(name), F.col(k))]
        attributes = (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,double>")
        shown = [F.col(k).alias(total[k]) for k in ("area", "length")]
        found.append(level.select(F.lit(layer.name).alias("layer"), "zoom", "cell_x", "cell_y", "feature_count", value.alias("value"), F.lit(layer.kind).alias("value_kind"), *shown, "cell_area_m2", (100 * F.col("area") / F.col("cell_area_m2")).alias("coverage_pct"), attributes.alias("attributes")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every
