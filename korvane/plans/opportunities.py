"""From what stands on a site and what could, to ranked opportunities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.relational import largest_label, rank_within

#: A use that holds so large a share of the floor area is the dominant one.
DOMINANT_SHARE = 0.70


def governing_column(columns: DataFrame, keys: list[str]) -> DataFrame:
    """The zoning column that governs each key: permitted, narrow enough for the frontage; the widest minimum wins, then the largest cap (none is endless), then the first."""
    fits = F.coalesce(F.col("min_width") <= F.col("frontage"), F.lit(True))
    w = Window.partitionBy(*keys).orderBy(F.coalesce("min_width", F.lit(0.0)).desc(), F.coalesce(F.col("cap").cast("double"), F.lit(float("inf"))).desc(), F.col("column_index"))
    ok = columns.where(F.coalesce(F.col("permits"), F.lit(False)) & fits)
    return ok.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def dominant_use(shares: list[tuple[str, Column]]) -> Column:
    """The use that fills DOMINANT_SHARE of the floor, else `mixed`; `none` without floor."""
    total = None
    for _, c in shares:
        part = F.coalesce(c, F.lit(0.0))
        total = part if total is None else total + part
    out = F.when(total <= 0, "none")
    for label, c in shares:
        out = out.when(F.coalesce(c, F.lit(0.0)) >= DOMINANT_SHARE * total, label)
    return out.otherwise("mixed")


def status(has_envelope: Column, governs: Column, solved: Column, npv: Column) -> Column:
    """Why a site has, or has no, best use; the first that applies."""
    return F.when(~has_envelope, "no_envelope").when(~governs, "not_governing").when(~solved, "infeasible").when(npv <= 0, "not_worthwhile").otherwise("best_use")


def best_use(programs: DataFrame, key: str) -> DataFrame:
    """The governing, solved program of the largest value for each site; the smaller column index of equal ones."""
    ok = programs.where("governs AND solved AND npv IS NOT NULL")
    w = Window.partitionBy(key).orderBy(F.desc("npv"), "column_index")
    return ok.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def gap(best: DataFrame, existing: DataFrame, key: str, measures: list[str]) -> DataFrame:
    """What the best use has beyond what stands; a site without a building has all of it."""
    rows = best.join(existing.select(key, *[F.col(m).alias(f"existing_{m}") for m in measures]), key, "left")
    return rows.withColumns({f"{m}_gap": F.col(m) - F.coalesce(f"existing_{m}", F.lit(0.0)) for m in measures})


def thesis(floors: list[tuple[str, Column]]) -> Column:
    """The kind of floor of which most would be added; the first of equal ones, `none` without any."""
    return largest_label([(label, F.when(c > 0, c)) for label, c in floors])


def yield_on_cost(noi: Column, cost: Column) -> Column:
    return F.when(cost > 0, noi / cost * 100)


def rank_opportunities(df: DataFrame, label: str, key: str, top: int) -> DataFrame:
    """Rank within each thesis: yield, value gained and cost (small first), then the key; and whether it is one of the top.

    There are three or four theses, so ranks are found over ranges and no task holds a thesis whole.
    """
    order = [F.desc_nulls_last("yield_pct"), F.desc_nulls_last("gain"), F.asc_nulls_last("cost"), F.asc(key)]
    return rank_within(df, [label], order, "thesis_rank").withColumn("is_top", F.col("thesis_rank") <= top)


def site_thesis(contaminated: Column, vacant: Column, year_built: Column, land_share: Column, gains: Column, old: int = 1960, worn: float = 0.6) -> Column:
    """Why to touch a site, the first that applies: brownfield, teardown (old, and mostly worth its land), infill (vacant), improvement (worth more enlarged)."""
    return (
        F.when(F.coalesce(contaminated, F.lit(False)), "brownfield")
        .when(~vacant & F.coalesce((year_built < old) & (land_share >= worn), F.lit(False)), "teardown")
        .when(vacant, "infill")
        .when(F.coalesce(gains > 0, F.lit(False)), "improvement")
        .otherwise("none")
    )


def screens(irr_pct: Column, yield_pct: Column, cover: Column, least_irr: float = 8.0, least_yield: float = 6.0, least_cover: float = 1.2) -> list[Column]:
    """Whether a site passes each screen, and all of them; a figure that is missing does not pass."""
    ok = [F.coalesce(c >= least, F.lit(False)) for c, least in ((irr_pct, least_irr), (yield_pct, least_yield), (cover, least_cover))]
    return [ok[0].alias("passes_irr"), ok[1].alias("passes_yield"), ok[2].alias("passes_cover"), (ok[0] & ok[1] & ok[2]).alias("passes")]


def road_gate(by_use: DataFrame, cadastral: DataFrame, marginal: DataFrame, other_use: DataFrame, key: str) -> DataFrame:
    """The parcels that are road: by their use, and by the cadastre, but for marginal ones that the roll uses otherwise."""
    doubtful = marginal.select(key).join(other_use.select(key), key, "left_semi")
    return by_use.select(key).union(cadastral.select(key).join(doubtful, key, "left_anti")).distinct()


def futures(hold: Column, enhance: Column, rebuild: Column) -> list[Column]:
    """The best of three futures of a site and what it gains over holding; the less invasive of equal ones, null values are no option."""
    best = largest_label([("hold", hold), ("enhance", enhance), ("rebuild", rebuild)])
    value = F.greatest(hold, enhance, rebuild)
    return [best.alias("future"), (value - F.coalesce(hold, F.lit(0.0))).alias("gain")]


def returns(flows: Column, noi: Column, cost: Column, debt_service: Column) -> list[Column]:
    """irr_pct, yield_pct, multiple (money back over money in) and cover (income over debt service) of yearly flows."""
    from ..functions.finance import irr

    money = lambda keep: F.aggregate(F.filter(flows, keep), F.lit(0.0), lambda s, f: s + f)
    out, back = -money(lambda f: f < 0), money(lambda f: f > 0)
    return [(irr(flows) * 100).alias("irr_pct"), yield_on_cost(noi, cost).alias("yield_pct"), F.when(out > 0, back / out).alias("multiple"), F.when(debt_service > 0, noi / debt_service).alias("cover")]
