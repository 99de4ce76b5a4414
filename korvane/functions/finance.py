"""Cash flows, values and returns as column expressions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def annuity(rate: Column, years: Column) -> Column:
    """What a payment of 1 a year is worth now."""
    return F.when(rate == 0, years.cast("double")).otherwise((1 - F.pow(1 + rate, -years)) / rate)


def reversion(rate: Column, years: Column) -> Column:
    """What 1 after so many years is worth now."""
    return F.pow(1 + rate, -years)


def npv(flows: Column, rate: Column) -> Column:
    """Of an array of yearly flows, the first of them now."""
    return F.aggregate(
        flows,
        F.struct(F.lit(0.0).alias("total"), F.lit(1.0).alias("factor")),
        lambda a, f: F.struct((a["total"] + f * a["factor"]).alias("total"), (a["factor"] / (1 + rate)).alias("factor")),
        lambda a: a["total"],
    )


def irr(flows: Column, low: float = -0.9, high: float = 2.0, steps: int = 80) -> Column:
    """The rate at which the flows are worth nothing, by bisection. Null unless flows of both signs occur and the range holds a change of sign, either way round."""
    signs = F.exists(flows, lambda f: f > 0) & F.exists(flows, lambda f: f < 0)
    first, last = npv(flows, F.lit(low)), npv(flows, F.lit(high))
    crosses = F.signum(first) * F.signum(last) < 0

    def halve(a: Column, _: Column) -> Column:
        middle = (a["lo"] + a["hi"]) / 2
        above = (npv(flows, middle) > 0) == (first > 0)
        return F.struct(F.when(above, middle).otherwise(a["lo"]).alias("lo"), F.when(above, a["hi"]).otherwise(middle).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct(F.lit(low).alias("lo"), F.lit(high).alias("hi")), halve, lambda a: (a["lo"] + a["hi"]) / 2)
    return F.when(signs & crosses, found)


def irr_of_many(flows: Column, low: float = -0.9, high: float = 2.0, steps: int = 80) -> Column:
    """irr() in batches: the same halvings, for all rows of a batch at once."""

    @F.pandas_udf("double")
    def run(rows: pd.Series) -> pd.Series:
        out = np.full(len(rows), np.nan)
        sizes = rows.map(lambda f: -1 if f is None else len(f)).to_numpy()
        for n in np.unique(sizes[sizes > 0]):
            at = np.flatnonzero(sizes == n)
            f = np.stack(rows.iloc[at].to_numpy()).astype(float)

            def worth(rate: np.ndarray | float, f: np.ndarray = f) -> np.ndarray:
                total, factor = np.zeros(len(f)), np.ones(len(f))
                for k in range(f.shape[1]):
                    total, factor = total + f[:, k] * factor, factor / (1 + rate)
                return total

            first = worth(low)
            ok = (f > 0).any(1) & (f < 0).any(1) & (np.sign(first) * np.sign(worth(high)) < 0)
            lo, hi = np.full(len(f), low), np.full(len(f), high)
            for _ in range(steps):
                middle = (lo + hi) / 2
                above = (worth(middle) > 0) == (first > 0)
                lo, hi = np.where(above, middle, lo), np.where(above, hi, middle)
            out[at] = np.where(ok, (lo + hi) / 2, np.nan)
        return pd.Series(out).astype(object).where(~np.isnan(out), None)

    return run(flows)


def expense_ratio(age: Column, base: float = 0.30, per_year: float = 0.0012, most_for_age: float = 0.10, cap: float = 0.60) -> Column:
    """Operating expenses over income; older buildings cost more, up to a limit."""
    return F.least(F.lit(base) + F.least(F.greatest(age, F.lit(0)) * per_year, F.lit(most_for_age)), F.lit(cap))


def yearly_income(dwellings: Column, rent: Column, area_m2: Column, rate_per_square_foot: Column, occupancy: Column) -> Column:
    """Dwellings at a monthly rent, and other floor area at a yearly rate for each square foot."""
    flats = F.coalesce(dwellings * rent * 12 * occupancy, F.lit(0.0))
    floors = F.coalesce(area_m2 / 0.09290304 * rate_per_square_foot * occupancy, F.lit(0.0))
    return flats + floors


def moved(value: Column, period: Column, index_then: Column, newest: Column, index_now: Column) -> Column:
    """A value of one period moved to the newest of its index, as struct(value, period, basis).

    measured where the periods are the same and the index has them, escalated where it was moved, else unescalated and as
    it was. The index is that of the value's own series.
    """
    ok = index_then.isNotNull() & index_now.isNotNull() & (index_then > 0)
    same = ok & (period == newest)
    return F.struct(
        F.when(ok & ~same, value * index_now / index_then).otherwise(value).alias("value"),
        F.when(ok, newest).otherwise(period).alias("period"),
        F.when(same, "measured").when(ok, "escalated").otherwise("unescalated").alias("basis"),
    )


def escalated(value: Column, index_then: Column, index_now: Column) -> Column:
    """A value moved by the ratio of an index, as struct(value, basis): escalated, or as it was where the index lacks a period."""
    ok = index_then.isNotNull() & index_now.isNotNull() & (index_then > 0)
    return F.struct(F.when(ok, value * index_now / index_then).otherwise(value).alias("value"), F.when(value.isNull(), "stated").when(ok, "escalated").otherwise("unescalated").alias("basis"))
