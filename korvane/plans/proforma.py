"""Returns of a site's futures for the one who buys it and the one who owns it, and the test of a good candidate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import worked_out
from ..functions.finance import irr_of_many


@dataclass(frozen=True)
class Terms:
    """Costs on top of hard ones, the pace of letting, what buildings are sold at, and the bars."""

    soft_pct: float = 20.0
    contingency_pct: float = 5.0
    risk_pct: float = 1.0
    selling_pct: float = 2.0
    construction_months: int = 18
    least_months: int = 6
    dwellings_a_month: float = 8.0
    commercial_m2_a_month: float = 200.0
    industrial_m2_a_month: float = 500.0
    hold_years: int = 10
    cap_pct: float = 4.5
    commercial_premium_pct: float = 1.75
    industrial_premium_pct: float = 1.25
    spread_bps: float = 150.0
    hurdle_bps: float = 100.0

    @property
    def factor(self) -> float:
        return 1 + (self.soft_pct + self.contingency_pct + self.risk_pct) / 100


USES = ("residential", "commercial", "industrial")


def cap_rate(income: dict[str, Column], t: Terms) -> Column:
    """The rate that a building of this mix of income is sold at: the base rate plus each use's premium by its share. Without income, the base."""
    part = {u: F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0)) for u, c in income.items()}
    total = part["residential"] + part["commercial"] + part["industrial"]
    extra = part["commercial"] * t.commercial_premium_pct + part["industrial"] * t.industrial_premium_pct
    return F.lit(t.cap_pct) + F.when(total > 0, extra / total).otherwise(0.0)


def months_to_let(dwellings: Column, commercial_m2: Column, industrial_m2: Column, t: Terms) -> Column:
    """The slowest of the uses, each at its own pace; at least the stated months."""
    pace = [F.ceil(F.coalesce(c, F.lit(0.0)) / rate) for c, rate in ((dwellings, t.dwellings_a_month), (commercial_m2, t.commercial_m2_a_month), (industrial_m2, t.industrial_m2_a_month))]
    return F.greatest(*pace, F.lit(t.least_months)).cast("int")


def flows(outlay: Column, budget: Column, income: Column, cap_pct: Column, t: Terms, let_months: Column | None = None, before: Column | None = None, cap_before_pct: Column | None = None) -> Column:
    """Yearly flows over the hold: the outlay now, the budget over the construction, then income as it is let, and the sale at the end.

    let_months null is a building that stands and is let from the first day. `before` is an income given up: flows are then
    those beyond it, its own sale price included.
    """
    zero = F.lit(0.0)
    built = t.construction_months if let_months is not None else 0

    def of_month(m: Column) -> Column:
        let = F.greatest(F.least((m - built).cast("double") / F.greatest(let_months, F.lit(1)), F.lit(1.0)), zero) if let_months is not None else F.lit(1.0)
        spent = F.when(m <= built, budget / max(built, 1)).otherwise(0.0)
        return F.coalesce(income, zero) / 12 * let - spent - (F.coalesce(before, zero) / 12 if before is not None else zero)

    sale = F.when(cap_pct > 0, F.coalesce(income, zero) / cap_pct * 100).otherwise(0.0)
    if before is not None:
        sale = sale - F.when(cap_before_pct > 0, F.coalesce(before, zero) / cap_before_pct * 100).otherwise(0.0)
    years = F.transform(F.sequence(F.lit(1), F.lit(t.hold_years)), lambda y: F.aggregate(F.sequence(12 * y - 11, 12 * y), zero, lambda s, m: s + of_month(m)) + F.when(y == t.hold_years, sale * (1 - t.selling_pct / 100)).otherwise(0.0))
    return F.concat(F.array(-F.coalesce(outlay, zero)), years)


def multiple(f: Column) -> Column:
    """Money back over money in."""
    total = lambda keep: F.aggregate(F.filter(f, keep), F.lit(0.0), lambda s, x: s + x)
    spent = -total(lambda x: x < 0)
    return F.when(spent > 0, total(lambda x: x > 0) / spent)


def returns(sites: DataFrame, t: Terms = Terms()) -> DataFrame:
    """sites with the figures of five flows: what a buyer has from holding, enhancing and rebuilding, and an owner from enhancing and rebuilding.

    Columns of sites: acquisition, site_costs, rebuild_cost, rebuild_{use}_noi, rebuild_dwellings, rebuild_{commercial,
    industrial}_m2, enhance_cost, enhance_{use}_noi (what it adds), enhance_dwellings, standing_noi. A null acquisition
    leaves a buyer without figures, a null or zero enhance_cost leaves enhancing without; other nulls count as nothing.
    """
    zero = F.lit(0.0)
    get = lambda c: F.coalesce(F.col(c), zero)
    rebuilt = {u: F.col(f"rebuild_{u}_noi") for u in USES}
    added = {u: F.col(f"enhance_{u}_noi") for u in USES}
    noi_after, noi_added = sum((get(f"rebuild_{u}_noi") for u in USES), zero), sum((get(f"enhance_{u}_noi") for u in USES), zero)
    standing = {"residential": F.col("standing_noi"), "commercial": zero, "industrial": zero}
    caps = {"rebuild": cap_rate(rebuilt, t), "enhance": cap_rate(added, t), "standing": cap_rate(standing, t)}
    both = {u: F.coalesce(standing[u], zero) + F.coalesce(added[u], zero) for u in USES}
    let = months_to_let(F.col("rebuild_dwellings"), F.col("rebuild_commercial_m2"), F.col("rebuild_industrial_m2"), t)
    let_added = months_to_let(F.col("enhance_dwellings"), zero, zero, t)
    enhanced, priced = F.coalesce(F.col("enhance_cost") > 0, F.lit(False)), F.col("acquisition").isNotNull()
    budget, budget_added, before = get("rebuild_cost") * t.factor, get("enhance_cost") * t.factor, get("standing_noi")
    hold = flows(F.col("acquisition"), zero, before, caps["standing"], t)
    adding = flows(zero, budget_added, noi_added, caps["enhance"], t, let_added)
    # A small file of sites is one task, and each row costs much: they are dealt over all partitions. What several figures use is worked out once.
    sites = sites.repartition(int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sites = worked_out(sites, _hold=hold, _adding=adding)
    hold, adding = F.col("_hold"), F.col("_adding")
    found = {
        "buyer_hold": (hold, priced),
        "buyer_enhance": (F.zip_with(hold, adding, lambda a, b: a + b), priced & enhanced),
        "buyer_rebuild": (flows(F.col("acquisition") + get("site_costs"), budget, noi_after, caps["rebuild"], t, let), priced),
        "owner_enhance": (adding, enhanced),
        "owner_rebuild": (flows(F.col("site_costs"), budget, noi_after, caps["rebuild"], t, let, before, caps["standing"]), F.lit(True)),
    }
    staged = worked_out(sites, **{f"_{k}": F.when(ok, f) for k, (f, ok) in found.items()})
    figures = {f"{k}_irr_pct": irr_of_many(F.col(f"_{k}")) * 100 for k in found} | {f"{k}_multiple": multiple(F.col(f"_{k}")) for k in found}
    cost, cost_added = F.col("acquisition") + get("site_costs") + budget, F.col("acquisition") + budget_added
    ratio = lambda a, b: F.when(b > 0, a / b * 100)
    yields = {"hold_yield_pct": ratio(before, F.col("acquisition")), "rebuild_yield_pct": ratio(noi_after, cost), "enhance_yield_pct": F.when(enhanced, ratio(before + noi_added, cost_added))}
    return staged.withColumns(figures | yields | {"rebuild_cap_pct": caps["rebuild"], "enhance_cap_pct": F.when(enhanced, cap_rate(both, t)), "rebuild_let_months": let}).drop("_hold", "_adding", *[f"_{k}" for k in found])


def screened(rows: DataFrame, thesis: str, verdict: str, t: Terms = Terms()) -> DataFrame:
    """Rows of returns() with the test of a good candidate: its yield beats its own cap rate by spread_bps, or its rate by hurdle_bps, and the verdict pays.

    An improvement is judged by enhancing, any other thesis by rebuilding; a missing figure does not pass.
    """
    own = lambda a, b: F.when(F.col(thesis) == "improvement", F.col(b)).otherwise(F.col(a))
    cap, rate, gain = own("rebuild_cap_pct", "enhance_cap_pct"), own("buyer_rebuild_irr_pct", "buyer_enhance_irr_pct"), own("rebuild_yield_pct", "enhance_yield_pct")
    ok = lambda c: F.coalesce(c, F.lit(False))
    clears_cap, clears_hurdle = ok((gain - cap) * 100 >= t.spread_bps), ok(rate >= cap + t.hurdle_bps / 100)
    return rows.withColumns({"site_irr_pct": rate, "site_yield_pct": gain, "site_hurdle_pct": cap + t.hurdle_bps / 100, "clears_cap": clears_cap, "clears_hurdle": clears_hurdle, "is_good": (clears_cap | clears_hurdle) & ok(F.col(verdict) > 0)})
