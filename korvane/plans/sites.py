"""Sites: what may be removed, what clearing costs, what each future is worth to an owner and to a buyer, and the ranked list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import present, truth
from ..operators.relational import largest_label, rank_within


@dataclass(frozen=True)
class SiteRules:
    """Fixed values that decide: years, costs a square metre, and which sectors keep a building standing."""

    exclude_heritage: bool = True
    exclude_review: bool = True
    exclude_old: bool = False
    review_year: int = 1940
    demolition_m2: float = 150.0
    demolition_m2_other: float = 250.0
    assessment: float = 12_000.0
    remediation_m2: float = 150.0
    remediation_m2_other: float = 75.0
    market_factor: float = 1.0
    require_gain: bool = True


def heritage_flags(heritage_sector: Column, review_sector: Column, year_built: Column, floor_m2: Column, rules: SiteRules = SiteRules()) -> list[Column]:
    """is_heritage_sector, has_review, demolition_review_required and is_demolition_restricted. The last needs a building: where no floor stands, nothing is removed."""
    heritage, review = present(heritage_sector), present(review_sector)
    asked = heritage | truth(year_built < rules.review_year)
    kept = (heritage & rules.exclude_heritage) | (review & rules.exclude_review) | (asked & rules.exclude_old)
    return [heritage.alias("is_heritage_sector"), review.alias("has_review"), asked.alias("demolition_review_required"), (truth(floor_m2 > 0) & kept).alias("is_demolition_restricted")]


def site_costs(floor_m2: Column, lot_m2: Column, housing_stands: Column, contaminated: Column, housing_share: Column, rules: SiteRules = SiteRules()) -> list[Column]:
    """demolition, assessment, remediation and site_costs. Contaminated ground is cleaned to the stricter rate where any housing is to come."""
    zero = F.lit(0.0)
    demolition = F.greatest(F.coalesce(floor_m2, zero), zero) * F.when(truth(housing_stands), rules.demolition_m2).otherwise(rules.demolition_m2_other)
    assessment = F.when(truth(contaminated), rules.assessment).otherwise(0.0)
    remediation = F.when(truth(contaminated), F.coalesce(lot_m2, zero) * F.when(truth(housing_share > 0), rules.remediation_m2).otherwise(rules.remediation_m2_other)).otherwise(0.0)
    return [demolition.alias("demolition"), assessment.alias("assessment"), remediation.alias("remediation"), (demolition + assessment + remediation).alias("site_costs")]


def futures(rows: DataFrame, rules: SiteRules = SiteRules()) -> DataFrame:
    """rows (hold, enhance_gain, rebuild, site_costs, assessed) with what each future is worth.

    The owner has the land in each: gains are over holding. A buyer pays the larger of the assessed value and what holding
    is worth, and buys for the best future, the less invasive of equal ones; `none` where even that loses. Without an
    assessed value a buyer has no figures; without a gain there is no enhancing.
    """
    zero = F.lit(0.0)
    hold = F.coalesce("hold", zero)
    enhance, rebuild = hold + F.col("enhance_gain"), F.col("rebuild") - F.coalesce("site_costs", zero)
    price = F.when(F.col("assessed").isNotNull(), F.greatest(F.col("assessed") * rules.market_factor, hold))
    owner = largest_label([("hold", zero), ("enhance", F.col("enhance_gain")), ("rebuild", rebuild - hold)])
    offers = {"hold": hold - price, "enhance": enhance - price, "rebuild": rebuild - price}
    best = F.greatest(*offers.values())
    buyer = F.when(price.isNotNull(), F.when(best >= 0, largest_label(list(offers.items()))).otherwise("none"))
    return rows.withColumns({"owner_gain_enhance": F.col("enhance_gain"), "owner_gain_rebuild": rebuild - hold, "owner_best": owner, "price": price, **{f"buyer_{k}": c for k, c in offers.items()}, "buyer_best": buyer})


def rank_sites(rows: DataFrame, thesis: str, rate: str, gain: str, verdict: str, key: str, top: int = 25, rules: SiteRules = SiteRules()) -> DataFrame:
    """rows with thesis_rank, is_top and num_ranked: sites with a rate, and a verdict above nothing if that is asked for, ranked within their thesis by rate, yield, verdict and key; the rest have no rank."""
    ok = F.col(thesis).isNotNull() & (F.col(thesis) != "none") & F.col(rate).isNotNull() & (truth(F.col(verdict) > 0) if rules.require_gain else F.lit(True))
    marked = rows.withColumn("_ok", ok)
    order = [F.desc_nulls_last(rate), F.desc_nulls_last(gain), F.desc_nulls_last(verdict), F.asc(key)]
    ranked = rank_within(marked, ["_ok", thesis], order, "thesis_rank")
    n = ranked.where("_ok").groupBy(F.col(thesis).alias("_t")).agg(F.count("*").alias("num_ranked"))
    out = ranked.join(n, F.col(thesis) == F.col("_t"), "left").withColumn("thesis_rank", F.when(F.col("_ok"), F.col("thesis_rank")))
    return out.withColumn("is_top", truth(F.col("thesis_rank") <= top)).withColumn("num_ranked", F.coalesce("num_ranked", F.lit(0))).drop("_ok", "_t")
