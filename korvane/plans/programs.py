"""Development programs: every admissible combination of floors is a row, and the best one of each site is kept.

What a site may hold is a handful of whole numbers (storeys by use, levels below ground) that its own limits bound, so the
choices of a site are some dozens of rows, or some hundreds for a tower. They are made by explode, judged by column expressions, and reduced by one aggregation with partial
results; no site is gathered anywhere, and the work grows with the number of sites.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import finance


@dataclass(frozen=True)
class Economics:
    unit_m2: float = 85.0
    stall_m2: float = 32.0
    surface_share: float = 0.25
    stalls_per_dwelling: float = 0.5
    stalls_per_100_m2: float = 1.0
    rent: float = 1400.0
    rate_per_square_foot: float = 24.0
    occupancy: float = 0.95
    expenses: float = 0.35
    cost_m2: float = 2600.0
    basement_cost_m2: float = 1500.0
    discount: float = 0.06
    years: int = 30


def choices(sites: DataFrame) -> DataFrame:
    """sites (key, buildable_m2, lot_m2, floors_max, commercial_max, basements_max, dwellings_max, density_max) once for each choice of floors."""
    upto = lambda c: F.sequence(F.lit(0), F.greatest(F.coalesce(c, F.lit(0)), F.lit(0)).cast("int"))
    rows = sites.withColumn("residential", F.explode(upto(F.col("floors_max"))))
    rows = rows.withColumn("commercial", F.explode(upto(F.least("commercial_max", F.col("floors_max") - F.col("residential")))))
    return rows.withColumn("basements", F.explode(upto(F.col("basements_max")))).where("residential + commercial > 0")


def judged(rows: DataFrame, e: Economics) -> DataFrame:
    """Choices with what they hold, need, cost and are worth, without those that break a limit. A null limit limits nothing."""
    plate = F.col("buildable_m2")
    dwellings = F.least(F.floor(plate * F.col("residential") / e.unit_m2), F.coalesce(F.col("dwellings_max").cast("long"), F.lit(1 << 40)))
    rows = rows.withColumn("dwellings", dwellings).withColumn("gross_m2", plate * (F.col("residential") + F.col("commercial")))
    needed = F.ceil(F.col("dwellings") * e.stalls_per_dwelling + plate * F.col("commercial") / 100 * e.stalls_per_100_m2)
    offered = F.floor(plate * F.col("basements") / e.stall_m2) + F.floor(F.greatest(F.col("lot_m2") - plate, F.lit(0.0)) * e.surface_share / e.stall_m2)
    rows = rows.withColumn("stalls", needed).where(needed <= offered)
    rows = rows.where(F.coalesce(F.col("gross_m2") / F.col("lot_m2") <= F.col("density_max"), F.lit(True)))
    income = finance.yearly_income(F.col("dwellings").cast("double"), F.lit(e.rent), plate * F.col("commercial"), F.lit(e.rate_per_square_foot), F.lit(e.occupancy))
    rows = rows.withColumn("noi", income * (1 - e.expenses)).withColumn("cost", F.col("gross_m2") * e.cost_m2 + plate * F.col("basements") * e.basement_cost_m2)
    return rows.withColumn("npv", F.col("noi") * finance.annuity(F.lit(e.discount), F.lit(e.years)) - F.col("cost"))


def best_programs(sites: DataFrame, e: Economics = Economics()) -> DataFrame:
    """(key, status, residential, commercial, basements, dwellings, stalls, gross_m2, noi, cost, npv) for each site.

    The choice of the largest value, to the cent; of equal ones the one with fewer residential, then commercial floors,
    then levels below ground. Sites that nothing fits are infeasible, with nulls.
    """
    names = ["residential", "commercial", "basements", "dwellings", "stalls", "gross_m2", "noi", "cost", "npv"]
    rows = judged(choices(sites), e)
    best = rows.groupBy("key").agg(F.min(F.struct((-F.round("npv", 2)).alias("_order"), *names)).alias("b"))
    out = sites.select("key").join(best, "key", "left")
    return out.select("key", F.when(F.col("b").isNull(), "infeasible").otherwise("optimal").alias("status"), *[F.col(f"b.{n}").alias(n) for n in names])


#: Storeys that an addition may have, and how much dearer its floor is than new floor on free ground.
ADDED_STOREYS, ADDITION_PREMIUM = 2, 1.5


def best_enhancements(sites: DataFrame, e: Economics = Economics(), most: int = ADDED_STOREYS, premium: float = ADDITION_PREMIUM) -> DataFrame:
    """(key, status, added_residential, added_commercial, added_dwellings, added_m2, added_noi, cost, npv): storeys put on what stands.

    sites has the columns of choices() and standing_m2, standing_storeys, standing_dwellings and share, the part of the
    building that stands on this piece (null: all). Its plate is its floor over its storeys. Limits of storeys, density
    and dwellings hold for the whole building; stalls for what is added must fit on free ground, as nothing is dug. The
    addition of the largest value counts, to the cent, of equal ones the smaller. status: no_building, no_room (nothing
    fits), nothing_pencils (the best loses money; its figures are null) or enhanced.
    """
    share = F.greatest(F.coalesce("share", F.lit(1.0)), F.lit(0.0))
    stands = F.coalesce((F.col("standing_m2") * share > 0) & (F.col("standing_storeys") >= 1), F.lit(False))
    rows = sites.withColumn("_stands", stands).withColumn("_floor", F.col("standing_m2") * share).withColumn("plate", F.col("_floor") / F.col("standing_storeys"))
    room = F.least(F.lit(most), F.coalesce(F.col("floors_max").cast("int"), F.lit(0)) - F.col("standing_storeys").cast("int"))
    upto = lambda c: F.sequence(F.lit(0), F.greatest(F.coalesce(c, F.lit(0)), F.lit(0)).cast("int"))
    tried = rows.where("_stands").withColumn("residential", F.explode(upto(room))).withColumn("commercial", F.explode(upto(F.least(F.coalesce(F.col("commercial_max").cast("int"), F.lit(0)), room - F.col("residential")))))
    tried = tried.where("residential + commercial > 0")
    standing = F.round(F.coalesce(F.col("standing_dwellings").cast("double"), F.lit(0.0)) * share).cast("long")
    left = F.greatest(F.coalesce(F.col("dwellings_max").cast("long"), F.lit(1 << 40)) - standing, F.lit(0))
    tried = tried.withColumn("dwellings", F.least(F.floor(F.col("plate") * F.col("residential") / e.unit_m2), left)).withColumn("added_m2", F.col("plate") * (F.col("residential") + F.col("commercial")))
    needed = F.ceil(F.col("dwellings") * e.stalls_per_dwelling + F.col("plate") * F.col("commercial") / 100 * e.stalls_per_100_m2)
    offered = F.floor(F.greatest(F.col("lot_m2") - F.col("plate"), F.lit(0.0)) * e.surface_share / e.stall_m2)
    fits = (needed <= offered) & F.coalesce((F.col("_floor") + F.col("added_m2")) / F.col("lot_m2") <= F.col("density_max"), F.lit(True))
    income = finance.yearly_income(F.col("dwellings").cast("double"), F.lit(e.rent), F.col("plate") * F.col("commercial"), F.lit(e.rate_per_square_foot), F.lit(e.occupancy))
    worth = tried.where(fits).withColumn("added_noi", income * (1 - e.expenses)).withColumn("cost", F.col("added_m2") * e.cost_m2 * premium)
    worth = worth.withColumn("npv", F.col("added_noi") * finance.annuity(F.lit(e.discount), F.lit(e.years)) - F.col("cost"))
    names = ["residential", "commercial", "dwellings", "added_m2", "added_noi", "cost", "npv"]
    best = worth.groupBy("key").agg(F.min(F.struct((-F.round("npv", 2)).alias("_order"), *names)).alias("b"))
    out = rows.select("key", "_stands").join(best, "key", "left")
    status = F.when(~F.col("_stands"), "no_building").when(F.col("b").isNull(), "no_room").when(F.col("b.npv") <= 0, "nothing_pencils").otherwise("enhanced")
    shown = lambda c, name: F.when(F.col("b.npv") > 0, F.col(f"b.{c}")).alias(name)
    return out.select("key", status.alias("status"), shown("residential", "added_residential"), shown("commercial", "added_commercial"), shown("dwellings", "added_dwellings"), *[shown(c, c) for c in ("added_m2", "added_noi", "cost", "npv")])
