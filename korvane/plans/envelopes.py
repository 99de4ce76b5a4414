"""Which pieces of ground a building is designed for: permitted, readable, and not zoned for a single house."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import truth

#: Uses that have a price.
FAMILIES = ("residential", "commercial", "industrial")
#: Dwellings up to which a piece is one for a single family.
SINGLE_FAMILY = 1


def has(df: DataFrame, name: str):
    return truth(F.col(name)) if name in df.columns else F.lit(False)


def candidate_rows(envelopes: DataFrame) -> DataFrame:
    """Rows that permit a use with a price and can be solved. Without any permits column, or without solver_ready, that test is passed."""
    permits = [has(envelopes, f"permits_{u}") for u in FAMILIES if f"permits_{u}" in envelopes.columns]
    some = permits[0] if permits else F.lit(True)
    for p in permits[1:]:
        some = some | p
    return envelopes.where(some & (has(envelopes, "solver_ready") if "solver_ready" in envelopes.columns else F.lit(True)))


def single_family_pieces(envelopes: DataFrame, piece: tuple[str, ...] = ("lot_uid", "feature_id")) -> DataFrame:
    """Pieces whose considered rows permit housing, always for one dwelling at most, and neither commerce nor industry.

    Considered are the rows that govern a use they permit; where a piece has none, all its candidate rows. A row without
    max_dwellings is not limited.
    """
    rows = candidate_rows(envelopes)
    governs = F.lit(False)
    for u in FAMILIES:
        governs = governs | (has(envelopes, f"governs_{u}") & has(envelopes, f"permits_{u}"))
    house, trade = has(envelopes, "permits_residential"), has(envelopes, "permits_commercial") | has(envelopes, "permits_industrial")
    several = house & ~truth(F.col("max_dwellings") <= SINGLE_FAMILY)
    flags = {"house": house, "trade": trade, "several": several}
    per = rows.groupBy(*piece).agg(F.bool_or(governs).alias("governed"), *[F.bool_or(c & governs).alias(f"g_{k}") for k, c in flags.items()], *[F.bool_or(c).alias(f"a_{k}") for k, c in flags.items()])
    at = lambda k: F.when(F.col("governed"), F.col(f"g_{k}")).otherwise(F.col(f"a_{k}"))
    return per.where(at("house") & ~at("trade") & ~at("several")).select(*piece)


def equipment_pieces(envelopes: DataFrame, piece: tuple[str, ...] = ("lot_uid", "feature_id")) -> DataFrame:
    """Pieces where a row permits public facilities, which have no price."""
    return envelopes.where(has(envelopes, "permits_equipment")).select(*piece).distinct()


def candidate_envelopes(envelopes: DataFrame, piece: tuple[str, ...] = ("lot_uid", "feature_id")) -> DataFrame:
    """The candidate rows of all pieces but those for a single family."""
    return candidate_rows(envelopes).join(single_family_pieces(envelopes, piece), list(piece), "left_anti").select(envelopes.columns)
