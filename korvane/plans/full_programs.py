"""The whole program of a site: storeys by use, footprint, a mix of unit sizes, stalls in the yard, in a garage and below ground.

A site's whole numbers are rows: its storeys, its footprint's candidates and its count of dwellings are exploded, one after the
other, and each step drops what breaks a limit. The mix of unit sizes is not: what n dwellings within an area are worth at most
depends on the market's rents alone, so it is worked out once a market by expanding size after size and dropping every
dominated state (no more worth on no less area for as many dwellings), and joined to the sites by market, count and area.
Each site keeps its best row by one aggregation with partial results. Nothing is gathered, and no solver runs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import finance
from ..functions.columns import SQUARE_METRES_PER_SQUARE_FOOT
from ..storage import stage

#: Areas of units are counted in hundreds of square feet.
STEP_M2 = 100 * SQUARE_METRES_PER_SQUARE_FOOT


@dataclass(frozen=True)
class Model:
    sizes: tuple[int, ...] = (5, 6, 9, 12)
    efficiency: float = 0.85
    storey_m: tuple[float, float, float] = (3.0, 4.0, 5.0)
    cost_m2: tuple[float, float, float] = (2600.0, 2400.0, 1800.0)
    basement_cost_m2: float = 1500.0
    rate_per_square_foot: tuple[float, float] = (24.0, 12.0)
    stall_m2: float = 32.0
    yard_share: float = 0.5
    stalls_per_dwelling: float = 0.5
    stalls_per_100_m2: float = 1.0
    yard_stall_cost: float = 5000.0
    garage_stall_cost: float = 20000.0
    stall_rent: float = 100.0
    absorption: tuple[float, ...] = (4000.0, 2500.0, 1500.0, 500.0)
    occupancy: float = 0.95
    expenses: float = 0.35
    discount: float = 0.06
    years: int = 30
    #: Whether ground that can't hold the smallest coverage refuses a site; otherwise such a site builds on all of its ground.
    coverage_min_refuses: bool = True


def present(yearly: Column, m: Model) -> Column:
    """What a yearly gross income is worth now."""
    return yearly * m.occupancy * (1 - m.expenses) * finance.annuity(F.lit(m.discount), F.lit(m.years))


def best_mixes(markets: DataFrame, m: Model = Model()) -> DataFrame:
    """(market, n, a, worth, mix): the most that n dwellings on at most a hundred square feet are worth, for every n and a up to the market's bounds.

    markets (market, rents: monthly rent of each size, null is not priced, most_units, most_area). mix counts the units of each
    size; of equal worth the mix on the least area counts, then that of fewest small units.
    """
    states = markets.select("*", F.lit(0).alias("n"), F.lit(0).alias("a"), F.lit(0.0).alias("worth"), F.array().cast("array<int>").alias("mix"))
    keys = ["market", "n", "a"]
    for k, size in enumerate(m.sizes):
        rent = F.get("rents", k)
        room = F.when(rent.isNotNull(), F.greatest(F.least(F.col("most_units") - F.col("n"), F.floor((F.col("most_area") - F.col("a")) / size).cast("int")), F.lit(0))).otherwise(0)
        grown = states.withColumn("c", F.explode(F.sequence(F.lit(0), room)))
        grown = grown.select("market", "rents", "most_units", "most_area", (F.col("n") + F.col("c")).alias("n"), (F.col("a") + F.col("c") * size).alias("a"), (F.col("worth") + F.col("c") * F.coalesce(present(rent * 12, m), F.lit(0.0))).alias("worth"), F.array_append("mix", F.col("c")).alias("mix"))
        top = grown.groupBy(*keys).agg(F.first("rents").alias("rents"), F.first("most_units").alias("most_units"), F.first("most_area").alias("most_area"), F.min(F.struct((-F.col("worth")).alias("w"), "mix")).alias("b"))
        top = top.select("market", "rents", "most_units", "most_area", "n", "a", (-F.col("b.w")).alias("worth"), "b.mix")
        before = Window.partitionBy("market", "n").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
        states = top.withColumn("_most", F.max("worth").over(before)).where(F.col("_most").isNull() | (F.col("worth") > F.col("_most"))).drop("_most")
    upto = F.coalesce(F.lead("a").over(Window.partitionBy("market", "n").orderBy("a")) - 1, F.col("most_area"))
    return states.withColumn("_to", upto).select("market", "n", F.explode(F.sequence("a", "_to")).alias("a"), "worth", "mix")


def refusal(m: Model) -> Column:
    """Why a site can't have any program, whatever is built; null where it might."""
    levels = F.greatest(*[F.coalesce(c, F.lit(0)) for c in ("residential_max", "commercial_max", "industrial_max")])
    all_levels = sum((F.coalesce(F.col(c), F.lit(0)) for c in ("residential_max", "commercial_max", "industrial_max")), F.lit(0))
    low = F.coalesce("coverage_min_pct", F.lit(0.0)) * F.col("lot_m2") / 100
    no_shops = F.greatest(F.coalesce("commercial_max", F.lit(0)), F.coalesce("industrial_max", F.lit(0))) == 0
    unpriced = ~F.exists("rents", lambda r: r.isNotNull())
    out = [
        ("height_range", F.col("height_min_m") > F.col("height_max_m")),
        ("height_max_below_floors_min", F.col("floors_min") * min(m.storey_m) > F.col("height_max_m")),
        ("no_usage_permitted", levels == 0),
        ("floors_min_exceeds_permitted_levels", F.coalesce("floors_min", F.lit(0)) > F.least(all_levels, F.coalesce("floors_max", F.lit(1 << 20)))),
        ("no_priced_unit_type", no_shops & unpriced),
        ("site_coverage_range", F.col("coverage_min_pct") > F.col("coverage_max_pct")),
    ]
    if m.coverage_min_refuses:
        out += [("buildable_area_below_site_coverage_min", F.col("buildable_m2") < low), ("placeable_area_below_site_coverage_min", F.col("placeable_m2") < low)]
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in out])


def storeys(sites: DataFrame, m: Model) -> DataFrame:
    """Sites once for each choice of residential, commercial and industrial storeys, levels below ground and footprint.

    Footprints are the smallest and the largest, and that at which the largest density is reached; what a site is worth is
    linear in the footprint between whole numbers of units and stalls.
    """
    upto = lambda c: F.sequence(F.lit(0), F.greatest(F.coalesce(c, F.lit(0)), F.lit(0)).cast("int"))
    most = F.least(F.coalesce("floors_max", F.lit(1 << 20)), F.floor(F.coalesce("height_max_m", F.lit(1e6)) / min(m.storey_m) + 1e-9))
    rows = sites.withColumn("r", F.explode(upto(F.least("residential_max", most))))
    rows = rows.withColumn("c", F.explode(upto(F.least(F.coalesce("commercial_max", F.lit(0)), most - F.col("r")))))
    rows = rows.withColumn("i", F.explode(upto(F.least(F.coalesce("industrial_max", F.lit(0)), most - F.col("r") - F.col("c")))))
    height = F.col("r") * m.storey_m[0] + F.col("c") * m.storey_m[1] + F.col("i") * m.storey_m[2]
    rows = rows.withColumn("floors", F.col("r") + F.col("c") + F.col("i")).withColumn("height_m", height).where("floors > 0")
    fits = (F.col("floors") >= F.coalesce("floors_min", F.lit(0))) & (F.col("height_m") <= F.coalesce("height_max_m", F.lit(1e6)) + 1e-9) & (F.col("height_m") >= F.coalesce("height_min_m", F.lit(0.0)) - 1e-9)
    rows = rows.where(fits).withColumn("b", F.explode(upto(F.col("basements_max"))))
    low = F.coalesce("coverage_min_pct", F.lit(0.0)) * F.col("lot_m2") / 100
    cover = F.coalesce(F.col("coverage_max_pct") * F.col("lot_m2") / 100, F.lit(1e12))
    rows = rows.withColumns({"low_m2": low, "cover_m2": cover, "high_m2": F.least("buildable_m2", cover, F.coalesce("placeable_m2", F.lit(1e12)))})
    dense = F.col("density_max") * F.col("lot_m2") / (F.col("floors") + F.col("b"))
    plates = F.array_distinct(F.array_compact(F.array(F.col("low_m2"), F.col("high_m2"), F.when(dense.between(F.col("low_m2"), F.col("high_m2")), dense))))
    rows = rows.withColumn("plate_m2", F.explode(plates)).where("plate_m2 > 0 AND plate_m2 <= high_m2")
    ratio = F.col("plate_m2") * (F.col("floors") + F.col("b")) / F.col("lot_m2")
    shops = F.col("plate_m2") * F.col("c")
    rows = rows.withColumn("density", ratio)
    return rows.where((ratio <= F.coalesce("density_max", F.lit(1e12)) + 1e-9) & (ratio >= F.coalesce("density_min", F.lit(0.0)) - 1e-9) & (shops <= F.coalesce("commercial_max_m2", F.lit(1e12)) + 1e-9))


def dwellings_range(m: Model) -> tuple[Column, Column]:
    """The fewest and the most dwellings that a site's limits leave a choice with residential storeys."""
    hectares = F.col("lot_m2") / 10_000
    least = F.ceil(F.coalesce(F.col("per_hectare_min") * hectares, F.lit(0.0)) - 1e-9)
    most = F.least(F.coalesce(F.col("dwellings_max").cast("long"), F.lit(1 << 40)), F.floor(F.coalesce(F.col("per_hectare_max") * hectares, F.lit(1e12)) + 1e-9), F.floor(F.col("plate_m2") * F.col("r") * m.efficiency / STEP_M2 / min(m.sizes) + 1e-9))
    return F.when(F.col("r") > 0, F.greatest(least, F.lit(1))).otherwise(0).cast("int"), F.when(F.col("r") > 0, most).otherwise(0).cast("int")


def parked(rows: DataFrame, m: Model, waived: bool) -> DataFrame:
    """Rows with the stalls that they need, where these go and what is left to units; once for each number of stalls that may be best.

    Stalls go below ground, then in the yard, and what is missing in a garage that takes residential floor, if the site
    may have one. More than needed may pay by rent and by quicker letting; that gain bends at quarters of the dwellings
    and at the demand for rented stalls, so these numbers, and all that yard and levels hold, are tried.
    """
    other = F.col("plate_m2") * (F.col("c") + F.col("i"))
    demand = F.lit(0) if waived else F.ceil(F.col("n") * m.stalls_per_dwelling + other / 100 * m.stalls_per_100_m2 - 1e-9)
    below = F.floor(F.col("plate_m2") * F.col("b") / m.stall_m2 + 1e-9)
    yard = F.least(F.coalesce(F.col("yard_stalls_max").cast("long"), F.lit(1 << 40)), F.floor(F.greatest(F.col("lot_m2") - F.col("plate_m2"), F.lit(0.0)) * m.yard_share / m.stall_m2 + 1e-9))
    needed = F.ceil(F.col("n") * m.stalls_per_dwelling + other / 100 * m.stalls_per_100_m2 - 1e-9).cast("int")
    rows = rows.withColumns({"demand": demand.cast("int"), "needed": needed, "below": below.cast("int"), "yard": yard.cast("int")})
    free = F.col("below") + F.col("yard")
    quarters = [F.ceil(F.col("n") * q / len(m.absorption)).cast("int") for q in range(1, len(m.absorption) + 1)]
    tried = F.array_distinct(F.transform(F.array(F.col("demand"), free, F.coalesce(F.col("market_stalls").cast("int"), F.lit(0)), *quarters), lambda s: F.greatest(F.col("demand"), F.least(s, free))))
    rows = rows.withColumn("stalls", F.explode(tried)).withColumn("garage", F.greatest(F.col("stalls") - free, F.lit(0)))
    garage_fits = (F.col("garage") == 0) | (F.coalesce("garage_allowed", F.lit(False)) & (F.col("garage") * m.stall_m2 <= F.col("plate_m2") + 1e-9) & (F.col("r") > 0))
    left = F.floor((F.col("plate_m2") * F.col("r") - F.col("garage") * m.stall_m2) * m.efficiency / STEP_M2 + 1e-9).cast("int")
    return rows.where(garage_fits).withColumn("a", F.greatest(left, F.lit(0)))


def letting_gain(m: Model) -> Column:
    """What stalls bring by quicker letting: each quarter of the dwellings' number of stalls gains less than the one before."""
    quarter = F.col("n") / len(m.absorption)
    parts = [F.greatest(F.least(F.col("stalls") - k * quarter, quarter), F.lit(0.0)) * gain for k, gain in enumerate(m.absorption)]
    return reduce(lambda x, y: x + y, parts)


def valued(rows: DataFrame, m: Model) -> DataFrame:
    """Rows (with worth and mix of their units) and their noi-free objective npv."""
    plate = F.col("plate_m2")
    foot = lambda storeys, rate: storeys * plate / SQUARE_METRES_PER_SQUARE_FOOT * rate
    income = present(foot(F.col("c"), m.rate_per_square_foot[0]) + foot(F.col("i"), m.rate_per_square_foot[1]), m)
    rented = F.least(F.col("stalls"), F.coalesce(F.col("market_stalls").cast("int"), F.lit(0)))
    in_yard = F.greatest(F.least(F.col("stalls") - F.col("garage") - F.col("below"), F.col("yard")), F.lit(0))
    floors = plate * (F.col("r") * m.cost_m2[0] + F.col("c") * m.cost_m2[1] + F.col("i") * m.cost_m2[2]) + plate * F.col("b") * m.basement_cost_m2
    cost = floors + in_yard * m.yard_stall_cost + F.col("garage") * m.garage_stall_cost
    npv = F.col("worth") + income + present(rented * m.stall_rent * 12, m) + letting_gain(m) - cost
    return rows.withColumns({"rented": rented, "yard_stalls": in_yard.cast("int"), "cost": cost, "npv": npv})


def binding(m: Model) -> Column:
    """The first limit that the best program of a site stands at; null where none does."""
    near = lambda a, b: F.coalesce(F.abs(a - b) <= 1e-6 * F.greatest(F.abs(b), F.lit(1.0)), F.lit(False))
    hectares = F.col("lot_m2") / 10_000
    reasons = [
        ("max_dwellings", (F.col("r") > 0) & (F.col("n") == F.col("dwellings_max"))),
        ("dwelling_density_max_per_ha", (F.col("r") > 0) & (F.col("n") == F.floor(F.col("per_hectare_max") * hectares + 1e-9))),
        ("commercial_floor_max_m2", near(F.col("plate_m2") * F.col("c"), F.col("commercial_max_m2")) & (F.col("c") > 0)),
        ("density_max", near(F.col("density"), F.col("density_max"))),
        ("floors", F.col("floors") == F.col("floors_max")),
        ("height_max", F.col("height_m") + min(m.storey_m) > F.col("height_max_m") + 1e-9),
        ("site_coverage_max", near(F.col("plate_m2"), F.col("cover_m2"))),
        ("placement", near(F.col("plate_m2"), F.col("placeable_m2"))),
        ("setbacks", near(F.col("plate_m2"), F.col("buildable_m2"))),
        ("basement_levels", (F.col("b") > 0) & (F.col("b") == F.col("basements_max"))),
        ("yard_full", (F.col("yard") > 0) & (F.col("yard_stalls") == F.col("yard"))),
    ]
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in reasons])


CHOSEN = ["r", "c", "i", "b", "n", "stalls", "garage", "yard_stalls", "rented", "needed", "plate_m2", "cost", "npv", "mix"]


def solved(sites: DataFrame, mixes: DataFrame, m: Model, waived: bool) -> DataFrame:
    """(key, best): the program of the largest npv of each site that can have one; to the cent, of equal ones that of fewest storeys, levels, dwellings and stalls. Choices are staged, which keeps plans short."""
    rows = stage(storeys(sites, m), "program-storeys")
    least, most = dwellings_range(m)
    rows = rows.withColumn("n", F.explode(F.when(most >= least, F.sequence(least, most)).otherwise(F.array().cast("array<int>"))))
    rows = stage(parked(rows, m, waived), "program-choices")
    rows = valued(rows.join(mixes, ["market", "n", "a"]), m).withColumn("binding", binding(m))
    return rows.groupBy("key").agg(F.min(F.struct((-F.round("npv", 2)).alias("_order"), *CHOSEN, "binding")).alias("best"))


def full_programs(sites: DataFrame, m: Model = Model()) -> DataFrame:
    """(key, status, binding, residential, commercial, industrial, basements, dwellings, stalls, garage_stalls, yard_stalls, rented_stalls, waived_stalls, footprint_m2, cost, npv, mix) for each site.

    sites (key, market, rents, lot_m2, buildable_m2, placeable_m2, coverage_min_pct, coverage_max_pct, floors_min, floors_max,
    height_min_m, height_max_m, residential_max, commercial_max, industrial_max: storeys of a use, null is none, density_min, density_max,
    dwellings_max, per_hectare_min, per_hectare_max, commercial_max_m2, basements_max, yard_stalls_max, garage_allowed,
    market_stalls: demand for rented stalls, waive_parking). Null limits limit nothing; rents are equal within a market.

    status is optimal, empty (binding nothing_pencils: the best loses money and nothing is built) or infeasible, with
    binding a refusal(), or no_program where no combination fits. Of sites that would be empty or without a program and may
    waive parking, those that a program without stalls suits get it, with what it would have needed as waived_stalls.
    """
    marked = stage(stage(sites, "program-sites").withColumn("refused", refusal(m)), "program-refused")
    open_ = marked.where("refused IS NULL")
    area = F.floor(F.least("buildable_m2", F.coalesce(F.col("coverage_max_pct") * F.col("lot_m2") / 100, F.lit(1e12)), F.coalesce("placeable_m2", F.lit(1e12))) * F.coalesce("residential_max", F.lit(0)) * m.efficiency / STEP_M2 + 1e-9)
    units = F.least(F.floor(area / min(m.sizes)), F.coalesce(F.col("dwellings_max").cast("long"), F.lit(1 << 30)))
    markets = open_.groupBy("market").agg(F.first("rents").alias("rents"), F.greatest(F.max(units), F.lit(0)).cast("int").alias("most_units"), F.greatest(F.max(area), F.lit(0)).cast("int").alias("most_area"))
    mixes = stage(best_mixes(markets, m), "program-mixes")
    first = stage(open_.join(solved(open_, mixes, m, False), "key", "left"), "program-first")
    again = first.where(F.coalesce("waive_parking", F.lit(False)) & (F.col("best").isNull() | (F.col("best.npv") <= 0))).select(*open_.columns)
    second = solved(again, mixes, m, True).where("best.npv > 0").withColumnRenamed("best", "second")
    out = marked.select("key", "refused").join(first.select("key", "best"), "key", "left").join(second, "key", "left")
    chosen = F.when(F.col("second").isNotNull(), F.col("second")).when(F.col("best.npv") > 0, F.col("best"))
    status = F.when(F.col("refused").isNotNull() | (F.col("best").isNull() & F.col("second").isNull()), "infeasible").when(F.col("_b").isNull(), "empty").otherwise("optimal")
    reason = F.coalesce(F.col("refused"), F.when(status == "infeasible", "no_program").when(status == "empty", "nothing_pencils").otherwise(F.col("_b.binding")))
    out = out.withColumn("_b", chosen).withColumn("status", status).withColumn("binding", reason)
    given = {"r": "residential", "c": "commercial", "i": "industrial", "b": "basements", "n": "dwellings", "stalls": "stalls", "garage": "garage_stalls", "yard_stalls": "yard_stalls", "rented": "rented_stalls"}
    waived = F.when(F.col("second").isNotNull(), F.col("second.needed")).otherwise(F.when(F.col("_b").isNotNull(), 0))
    return out.select("key", "status", "binding", *[F.col(f"_b.{k}").alias(v) for k, v in given.items()], waived.alias("waived_stalls"), F.col("_b.plate_m2").alias("footprint_m2"), *[F.col(f"_b.{k}").alias(k) for k in ("cost", "npv", "mix")])
