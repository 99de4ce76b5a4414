"""Lots: frontage, pieces by zone, storeys, and what stands where in a building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spatial import edges

#: A piece counts if it is so large a share of the lot and so large, or large by itself.
LEAST_SHARE, LEAST_AREA, LARGE_AREA = 0.01, 1.0, 500.0
LEAST_FRONTAGE_M = 0.5


def shared_edges(lots: DataFrame, roads: DataFrame) -> DataFrame:
    """(lot, road, length): the length of boundary that a lot has in common with each road parcel.

    lots (lot, ring) and roads (road, ring) share vertices, as published parcels do, so equal sides are found by an
    equi-join on their end points, taken in a fixed order.
    """

    def sides(df: DataFrame, key: str) -> DataFrame:
        e = df.select(key, F.explode(edges(F.col("ring"))).alias("e")).select(key, F.col("e.a").alias("p"), F.col("e.b").alias("q"))
        return e.select(key, F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"))

    both = sides(lots, "lot").join(sides(roads, "road"), ["p", "q"])
    length = F.hypot(F.col("q.x") - F.col("p.x"), F.col("q.y") - F.col("p.y"))
    return both.groupBy("lot", "road").agg(F.sum(length).alias("length"))


def frontage(shared: DataFrame, least: float = LEAST_FRONTAGE_M) -> DataFrame:
    """One row a lot: its two longest frontages, and how many it has."""
    w = Window.partitionBy("lot").orderBy(F.desc("length"), "road")
    ranked = shared.where(F.col("length") >= least).withColumn("rank", F.row_number().over(w))
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    return ranked.groupBy("lot").agg(at(1, "road").alias("primary_road"), at(1, "length").alias("primary_m"), at(2, "road").alias("secondary_road"), at(2, "length").alias("secondary_m"), F.count("*").alias("num_frontages"))


def piece_frontage(shared: DataFrame, keys: tuple[str, ...] = ("lot", "zone"), least: float = LEAST_FRONTAGE_M) -> DataFrame:
    """(keys, road, length, frontage_rank): frontages of at least `least` ranked anew within each piece of a lot."""
    w = Window.partitionBy(*keys).orderBy(F.desc("length"), "road")
    return shared.where(F.col("length") >= least).withColumn("frontage_rank", F.row_number().over(w)).select(*keys, "road", "length", "frontage_rank")


def zone_pieces(overlaps: DataFrame) -> DataFrame:
    """Pieces of lots by zone from overlaps (lot, zone, area, lot_area): those that count, with share, rank and the number of zones."""
    share = F.col("area") / F.nullif("lot_area", F.lit(0.0))
    kept = overlaps.withColumn("pct_of_lot", share * 100).where(((share >= LEAST_SHARE) & (F.col("area") >= LEAST_AREA)) | (F.col("area") >= LARGE_AREA))
    lot = Window.partitionBy("lot")
    ranked = kept.withColumn("zone_rank", F.row_number().over(lot.orderBy(F.desc("area"), "zone"))).withColumn("num_lot_zones", F.count("*").over(lot)).withColumn("area_share", F.col("area") / F.sum("area").over(lot))
    return ranked.withColumn("is_primary_zone", F.col("zone_rank") == 1)


def permitted_floors(floors_max: Column, height_max: Column, ground: float = 4.0, above: float = 3.0) -> Column:
    """The fewer of what the storeys and what the height allow; null where neither is limited. One storey is always allowed by height."""
    by_height = F.when(height_max.isNotNull(), F.greatest(F.floor((height_max - ground) / above) + 1, F.lit(1)))
    return F.least(floors_max.cast("long"), by_height.cast("long"))


#: Dwellings that each class of housing may hold, null without a limit.
CLASS_DWELLINGS = {"H.1": 1, "H.2": 2, "H.3": 3, "H.4": 8, "H.5": 12, "H.6": 36, "H.7": None}
#: Levels a grid may mark for a use.
ALL, ALL_BUT_GROUND, GROUND, BELOW, SECOND = "all", "all_except_ground", "ground", "below_ground", "second"


def storeys_by_levels(levels: Column, total: Column) -> Column:
    """How many of a building's storeys the marked levels (an array) give a use: they add up, to the whole at most; a cellar is no storey."""
    share = lambda x: F.when(x == ALL, total).when(x == ALL_BUT_GROUND, F.greatest(total - 1, F.lit(0))).when(x.isin(GROUND, SECOND), F.lit(1)).otherwise(F.lit(0)).cast("int")
    return F.least(F.aggregate(F.array_distinct(levels), F.lit(0), lambda s, x: s + share(x)), total.cast("int"))


def basement_levels(levels: Column, dwellings: bool, allowed: int = 1) -> Column:
    """Levels below ground that the marks allow: dwellings need the mark for it, other uses have it with 'all levels' too."""
    reach = F.array_contains(levels, BELOW) if dwellings else F.array_contains(levels, BELOW) | F.array_contains(levels, ALL)
    return F.when(F.coalesce(reach, F.lit(False)), allowed).otherwise(0)


def storey_ceiling(height_max: Column, storey: float = 3.0) -> Column:
    """The most storeys a height could hold, one at least; null without a height."""
    return F.when(height_max.isNotNull(), F.greatest(F.floor(height_max / storey), F.lit(1)).cast("int"))


def class_max_dwellings(usages: Column) -> Column:
    """The limit of the most permissive housing class among usage codes (an array), footnotes aside. Null without housing, with a class that has no limit, and with a code of no class."""
    codes = F.transform(usages, lambda u: F.trim(F.regexp_replace(u, r"\(\s*\d+\s*\)", "")))
    homes = F.filter(codes, lambda u: u.rlike(r"^H(\.\d+[A-Za-z]?)?$"))
    limits = F.create_map(*[F.lit(x) for k, v in CLASS_DWELLINGS.items() if v is not None for x in (k, v)])
    caps = F.transform(homes, lambda u: F.try_element_at(limits, F.regexp_extract(u, r"^(H\.\d+)", 1)))
    return F.when(~F.exists(caps, lambda c: c.isNull()), F.array_max(caps))


def floor_stack(parts: list[tuple[str, Column, Column]]) -> Column:
    """Runs of floors as array<struct(use, from_level, to_level, floors, area)>, the parts in the order given from level 1; parts without floors are left out."""
    runs = F.filter(F.array(*[F.struct(F.lit(use).alias("use"), F.coalesce(n, F.lit(0)).cast("int").alias("floors"), plate.cast("double").alias("plate")) for use, n, plate in parts]), lambda r: r["floors"] > 0)
    none = F.array().cast("array<struct<use:string,from_level:int,to_level:int,floors:int,area:double>>")

    def step(a: Column, r: Column) -> Column:
        run = F.struct(r["use"].alias("use"), (a["level"] + 1).alias("from_level"), (a["level"] + r["floors"]).alias("to_level"), r["floors"].alias("floors"), (r["plate"] * r["floors"]).alias("area"))
        return F.struct((a["level"] + r["floors"]).alias("level"), F.concat(a["runs"], F.array(run)).alias("runs"))

    return F.aggregate(runs, F.struct(F.lit(0).alias("level"), none.alias("runs")), step, lambda a: a["runs"])


def apportioned(values: DataFrame, pairs: DataFrame) -> DataFrame:
    """(lot, n_units, whole, apportioned): values (unit, value) summed over the lots of (unit, lot), whole and divided by the unit's number of lots."""
    lots = pairs.distinct()
    n = lots.groupBy("unit").agg(F.count("*").alias("_n"))
    rows = lots.join(n, "unit").join(values, "unit")
    return rows.groupBy("lot").agg(F.countDistinct("unit").alias("n_units"), F.sum("value").alias("whole"), F.sum(F.col("value") / F.col("_n")).alias("apportioned"))


def lease_up(stable: Column, months_to_fill: Column, years: int) -> Column:
    """Yearly income of a building that fills evenly over so many months: an array, each year the sum of its twelve months."""
    month = lambda k: F.when(months_to_fill > 0, F.least(F.lit(k).cast("double") / months_to_fill, F.lit(1.0))).otherwise(1.0)
    total = lambda y: sum((month(k) for k in range(12 * y + 2, 12 * y + 13)), month(12 * y + 1))
    return F.array(*[stable / 12 * total(y) for y in range(years)])


def cash_flows(cost: Column, stable: Column, months_to_fill: Column, cap_rate: Column, years: int) -> Column:
    """Minus the cost now, then the years' income, with the sale at the capitalised stable income in the last."""
    income = lease_up(stable, months_to_fill, years)
    sale = F.when(cap_rate > 0, stable / cap_rate).otherwise(0.0)
    return F.concat(F.array(-cost), F.transform(income, lambda v, k: v + F.when(k == years - 1, sale).otherwise(0.0)))


#: How much of the side margin a building keeps, by how it is attached.
SIDE_MARGINS = {"attached": 0.0, "semi": 0.5, "detached": 1.0}


def buildable_box(width: Column, depth: Column, front: Column, rear: Column, side: Column, kind: Column, coverage_pct: Column) -> Column:
    """struct(area, cap, binding) of a rectangular lot: what the margins leave, or the coverage allows, and which of them binds.

    Both sides keep the share of the side margin that the kind asks for; null margins are none, a null coverage is no limit.
    """
    zero = F.lit(0.0)
    share = F.when(kind == "attached", SIDE_MARGINS["attached"]).when(kind == "semi", SIDE_MARGINS["semi"]).otherwise(SIDE_MARGINS["detached"])
    across = F.greatest(width - 2 * share * F.coalesce(side, zero), zero)
    along = F.greatest(depth - F.coalesce(front, zero) - F.coalesce(rear, zero), zero)
    area = across * along
    cover = width * depth * coverage_pct / 100
    return F.struct(area.alias("area"), F.least(area, cover).alias("cap"), F.when(area <= 0, "margins").when(cover < area, "coverage").otherwise("margins").alias("binding"))


#: Distances within which a boundary may follow a street that it does not touch, tried in turn.
FALLBACK_M = (8.0, 16.0)


def fallback_frontage(lots: DataFrame, streets: DataFrame, ladder: tuple[float, ...] = FALLBACK_M) -> DataFrame:
    """(lot, street, length, cutoff_m) for lots (lot, ring) that share no vertices with a road.

    A side fronts on a street (street, ax, ay, bx, by) if both its ends lie within the cutoff and it runs within 45
    degrees of the street's direction. A wider cutoff is tried only for lots that the narrower ones found nothing for.
    """
    from .spatial import box, cell_join, segment_distance

    sides = lots.select("lot", F.explode(edges(F.col("ring"))).alias("e")).select("lot", *[F.col(f"e.{p}.{c}").alias(f"{p}{c}_") for p in "ab" for c in "xy"])
    side_box = box(F.least("ax_", "bx_"), F.least("ay_", "by_"), F.greatest("ax_", "bx_"), F.greatest("ay_", "by_"))
    street_box = box(F.least("ax", "bx"), F.least("ay", "by"), F.greatest("ax", "bx"), F.greatest("ay", "by"))
    ends = [segment_distance(F.col(f"{p}x_"), F.col(f"{p}y_"), *[F.col(c) for c in ("ax", "ay", "bx", "by")]) for p in "ab"]
    dx, dy, sx, sy = F.col("bx_") - F.col("ax_"), F.col("by_") - F.col("ay_"), F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    length = F.hypot(dx, dy)
    along = F.abs(dx * sx + dy * sy) >= length * F.hypot(sx, sy) * (0.5**0.5)
    out = None
    for cutoff in ladder:
        rest = sides if out is None else sides.join(out.select("lot").distinct(), "lot", "left_anti")
        near = cell_join(rest, streets, side_box, street_box, 50.0, (ends[0] <= cutoff) & (ends[1] <= cutoff) & along & (length > 0), cutoff)
        found = near.groupBy("lot", "street").agg(F.sum(length).alias("length")).withColumn("cutoff_m", F.lit(cutoff))
        out = found if out is None else out.unionByName(found)
    return out


def point_along(line: Column, share: float = 0.5) -> Column:
    """struct(x, y): the point at a share of the length of a line, an array of struct(x, y). Null for less than two points."""
    n = F.size(line)
    steps = F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.struct(F.get(line, k - 1).alias("a"), F.get(line, k).alias("b")))
    size = lambda s: F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"])
    goal = F.aggregate(steps, F.lit(0.0), lambda t, s: t + size(s)) * share
    start = F.struct(F.lit(0.0).alias("done"), F.get(line, 0)["x"].alias("x"), F.get(line, 0)["y"].alias("y"))

    def step(a: Column, s: Column) -> Column:
        t = F.greatest(F.least((goal - a["done"]) / F.nullif(size(s), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
        moved = t.isNotNull() & (goal >= a["done"])
        return F.struct((a["done"] + size(s)).alias("done"), F.when(moved, s["a"]["x"] + t * (s["b"]["x"] - s["a"]["x"])).otherwise(a["x"]).alias("x"), F.when(moved, s["a"]["y"] + t * (s["b"]["y"] - s["a"]["y"])).otherwise(a["y"]).alias("y"))

    found = F.aggregate(steps, start, step, lambda a: F.struct(a["x"].alias("x"), a["y"].alias("y")))
    return F.when(n >= 2, found)
